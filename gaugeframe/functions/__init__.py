"""Column expressions used by the operators; all of them are built-in functions."""
