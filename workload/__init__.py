"""Queries over the given tables, one per operator, and their DuckDB counterparts."""
