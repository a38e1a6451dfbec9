"""Operators for preparing training data: deduplication, filtering, scoring, sampling and packing of documents."""
