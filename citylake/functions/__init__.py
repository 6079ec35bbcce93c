"""Column-in, Column-out functions."""
