"""Reading the two sides and writing results."""
