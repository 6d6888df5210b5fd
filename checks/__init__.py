"""Registered benchmark/correctness queries and their DuckDB oracles."""
