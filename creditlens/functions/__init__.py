"""Column expressions: validation, scoring, bands and test statistics."""
