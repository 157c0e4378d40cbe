"""Whole jobs, and the catalog of queries over the provided tables."""
