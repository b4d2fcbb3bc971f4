"""Column expressions: cycle windows and report text."""
