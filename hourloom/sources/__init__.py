"""Readers of raw files, and stage tables."""
