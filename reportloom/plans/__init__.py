"""Queries composed from the operators, and the same in SQL."""
