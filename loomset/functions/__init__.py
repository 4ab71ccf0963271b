"""Column expressions: text tests, templates and row formats."""
