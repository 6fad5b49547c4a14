"""Models and queries: staging, dimensions, facts, marts, metrics, relations, checks."""
