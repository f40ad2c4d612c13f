"""Queries and their SQL twins."""
