"""Operators of a training-data pipeline: packing, mixing, extraction, deduplication and more."""
