"""Operators for preparing training data: mixing, selection, deduplication, packing, search."""
