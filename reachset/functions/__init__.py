"""Column-level predicates and date helpers."""
