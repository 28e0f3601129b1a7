"""Column helpers: text, numbers, dates. All native expressions, no Python UDF."""
