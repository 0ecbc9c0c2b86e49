"""Column expressions: every function takes and returns Columns (or column names)."""
