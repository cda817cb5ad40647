"""Operators for training-data pipelines: filtering, deduplication, scoring, formatting, packing."""
