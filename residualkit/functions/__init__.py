"""Column expressions and column-name helpers."""
