"""Column expressions: text, numbers and months. No Python runs per row."""
