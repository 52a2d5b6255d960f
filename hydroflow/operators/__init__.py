"""Operators: each takes DataFrames and returns a DataFrame, for many series at once."""
