"""Operators for training-data pipelines: filters, near copies, packing, search."""
