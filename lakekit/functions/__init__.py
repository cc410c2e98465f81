"""Column functions and user-defined functions."""
