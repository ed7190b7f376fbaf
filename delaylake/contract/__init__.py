"""Registered queries, their inputs from the given tables, and their SQL twins."""
