"""Column expressions: versions, dates, text and name templates."""
