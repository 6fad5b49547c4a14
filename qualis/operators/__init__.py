"""Reusable DataFrame operators: dimension lookup, incremental loads, keyed merge."""
