"""Whole-table queries over the given parquet tables, and their SQL counterparts."""
