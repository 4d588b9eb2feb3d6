"""Column expressions, window frames and join shapes used by the operators."""
