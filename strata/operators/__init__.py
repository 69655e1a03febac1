"""Operators: fit -> bounded statistics, apply -> lazy column expressions."""
