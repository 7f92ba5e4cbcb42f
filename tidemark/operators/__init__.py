"""Operators on DataFrames: each takes frames and column names and returns a frame."""
