"""Column functions: vectors, text, and reproducible random draws."""
