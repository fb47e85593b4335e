"""Column functions: casts, derivation rules and vector arithmetic."""
