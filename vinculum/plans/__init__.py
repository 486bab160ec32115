"""Composition: the import scenario, the registered queries and their DuckDB oracles."""
