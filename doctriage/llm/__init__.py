"""Operators for training-data pipelines: dedup, mixing, filters, tokens, packing, sharding."""
