"""Column expressions: calendar, geography, text and statistics."""
