"""Column-expression helpers (no UDFs)."""
