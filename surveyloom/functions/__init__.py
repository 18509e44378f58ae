"""Column functions with the NULL rules that harmonisation needs."""
