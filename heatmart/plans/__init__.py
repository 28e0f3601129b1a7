"""Composite models: staging tables, dimensions, the daily fact and its wide frame."""
