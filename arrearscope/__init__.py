"""Probability-of-default analytics on Spark DataFrames."""
