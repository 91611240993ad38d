"""Relational operators over the term tables."""
