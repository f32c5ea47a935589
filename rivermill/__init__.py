"""Layered e-commerce warehouse operators on Spark DataFrames."""
