"""Column expressions: URL, date, text, number, reply and page-text functions."""
