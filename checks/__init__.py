"""Queries over the test tables, each with its equivalent in plain SQL."""
