"""Operators. Each takes DataFrames and returns a DataFrame."""
