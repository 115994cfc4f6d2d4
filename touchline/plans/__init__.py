"""Whole jobs, and the registered queries that run each operator over the given tables."""
