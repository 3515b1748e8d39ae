"""Harmonise, select and publish statistical indicators with Spark DataFrames."""
