"""Encoding a stream of documents."""
