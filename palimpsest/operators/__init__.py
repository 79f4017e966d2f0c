"""Transformations of DataFrames, and the writes at the end of them."""
