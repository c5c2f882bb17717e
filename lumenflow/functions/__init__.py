"""Column functions without data of their own."""
