"""Column expressions and helpers (see ``expr``)."""
