"""Column expressions: text, term weights, significance."""
