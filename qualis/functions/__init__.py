"""Column expressions: id text forms, surrogate keys, safe parsing, date keys."""
