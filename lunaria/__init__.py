"""Wearable-signal analytics on Spark DataFrames."""
