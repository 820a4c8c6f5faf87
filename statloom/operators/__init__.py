"""Operators over DataFrames, grouped by purpose."""
