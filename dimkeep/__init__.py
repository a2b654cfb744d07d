"""Incremental dimensional loading on Spark DataFrames."""
