"""Column expressions: text, dates, numbers, labels, string similarity."""
