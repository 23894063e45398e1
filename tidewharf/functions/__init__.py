"""Column expressions and helpers shared by the operators."""
