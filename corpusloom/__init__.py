"""Corpus statistics, positional indexes and fielded ranked search on Spark DataFrames."""
