"""Column-returning helpers."""
