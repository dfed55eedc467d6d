"""Operators for training-data pipelines: filters, dedup, packing, search, archives."""
