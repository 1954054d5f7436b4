"""Column expressions: each takes Columns (or names) and returns a Column."""
