"""Cleaning, splitting, ranking, factoring, scoring and serving, on DataFrames."""
