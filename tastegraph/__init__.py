"""Recommendation and text-similarity operators on Spark DataFrames."""
