"""Column expressions: dates, numbers, text, bins and distribution tails."""
