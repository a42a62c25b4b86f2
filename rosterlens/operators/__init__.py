"""Relational operators on canonical tables."""
