"""Relational operators on the filing tables."""
