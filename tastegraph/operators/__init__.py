"""The operators: DataFrames in, DataFrames out."""
