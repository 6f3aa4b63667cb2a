"""Operators for preparing training data: packing, deduplication, mixing, filtering, formatting."""
