"""Batch analytics over layered datasets, on Spark DataFrames."""
