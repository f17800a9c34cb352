"""Operators of a training-data pipeline: filters, scans, fingerprints, duplicates, packing."""
