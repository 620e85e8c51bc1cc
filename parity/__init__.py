"""Queries over the supplied tables, each with a SQL text that gives the same rows."""
