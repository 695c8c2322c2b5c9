"""Column-expression builders and fixed values."""
