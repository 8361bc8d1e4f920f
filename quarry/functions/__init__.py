"""Column functions: text, tables, vectors."""
