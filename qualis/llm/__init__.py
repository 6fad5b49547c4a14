"""Training-data operators: dedup, filtering, privacy, scoring, mixing and packing of documents."""
