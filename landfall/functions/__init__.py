"""Column expressions: dates, numbers, flags and passenger lists."""
