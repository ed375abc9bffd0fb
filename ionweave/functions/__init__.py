"""Column functions: each takes columns and returns a column, no Python per row."""
