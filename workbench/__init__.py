"""Derives the urban feeds from the given tables and registers the queries."""
