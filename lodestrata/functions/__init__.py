"""Column functions: text, dates, numbers, identifiers and URLs."""
