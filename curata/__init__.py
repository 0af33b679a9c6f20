"""Curata: dataset-curation analytics on Spark DataFrames."""
