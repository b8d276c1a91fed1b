"""Operators for large-scale training-data pipelines.

Every operator takes a DataFrame and column names, reads only the columns it
names (other columns, clashing or not, are ignored) and returns a DataFrame.
"""
