"""Column expressions: attribution from names and labels, arithmetic, dates."""
