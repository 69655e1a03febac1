"""Column-expression builders and seeded hashing."""
