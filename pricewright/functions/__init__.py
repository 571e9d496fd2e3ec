"""Column functions and numeric helpers."""
