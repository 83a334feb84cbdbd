"""Comparison, summary, ranking and repair over DataFrames."""
