"""Queries over the given tables, with SQL that computes the same results."""
