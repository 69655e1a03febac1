"""Registered queries, their DuckDB oracles, the staged pipeline."""
