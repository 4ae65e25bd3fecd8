"""Frequency tables, positional postings, fielded index and search operators."""
