"""Column expressions shared by the operators and the plans."""
