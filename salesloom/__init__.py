"""Retail lakehouse operators on Spark: every operator is a function from DataFrames to a DataFrame."""

__version__ = "0.1.0"
