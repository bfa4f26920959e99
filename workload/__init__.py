"""Benchmark and correctness workload over the given test tables."""
