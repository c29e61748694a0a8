"""Whole surveys, and the registered queries over the given tables."""
