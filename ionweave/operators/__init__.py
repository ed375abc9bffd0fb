"""Relational operators over edge, node and match tables."""
