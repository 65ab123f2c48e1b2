"""Operators for large training-data pipelines: scoring, filtering, deduplication, extraction, packing."""
