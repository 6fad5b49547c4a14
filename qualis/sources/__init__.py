"""Readers for landed files, the raw fixtures and the versioned parquet warehouse."""
