"""Joins and aggregations: vocabulary tables, encoding, counts, requests, parity."""
