"""Corpus and usage analytics as Spark DataFrames."""
