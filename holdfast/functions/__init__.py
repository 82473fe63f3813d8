"""Column builders: exact arithmetic, text cleaning, rule flags and masks."""
