"""Operators chained into the five retail analyses."""
