"""Column expressions, exact order statistics and distributed ranking."""
