"""Column rules: each function takes columns and returns a column."""
