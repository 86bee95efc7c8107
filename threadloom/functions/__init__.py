"""Column functions: text cleaning, field normalisation and measures."""
