"""Column expressions: text, headers, taxonomy, identifiers."""
