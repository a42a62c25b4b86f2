"""Whole comparisons, and the queries on the driver tables."""
