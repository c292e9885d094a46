"""Relational operators over log tables."""
