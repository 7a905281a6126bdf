"""Queries that bind the operators to the test tables, each with an independent SQL form."""
