"""Reading landed files and raw tables, writing tables."""
