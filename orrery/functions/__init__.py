"""Column expressions: calendar attributes, document conditions, checked casts."""
