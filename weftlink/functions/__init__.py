"""Column functions: text cleaning, scripts, similarity."""
