"""Operators for large training-data pipelines over Spark DataFrames."""
