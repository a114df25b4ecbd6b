"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it. Every operator takes and returns
DataFrames, reads only the columns it names and tolerates any others.
"""
