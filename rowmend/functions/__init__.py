"""Column choice, type alignment, time windows, literals and encryption."""
