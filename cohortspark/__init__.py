"""Longitudinal table analytics on Spark DataFrames."""
