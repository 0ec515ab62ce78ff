"""Operators of a training-data pipeline, each on DataFrames of documents.

Nothing outside this package imports it.  ``queries.py`` binds the operators to the tables.
"""
