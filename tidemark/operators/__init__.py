"""Operators: DataFrames in, DataFrame out, no actions inside unless stated."""
