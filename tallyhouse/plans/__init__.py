"""Models: staging, dimensions, facts, marts, metrics and their checks."""
