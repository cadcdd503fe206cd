"""Operators of a large-scale training-data pipeline over a documents table.

Every operator is a function of DataFrames; ``queries`` applies each to its
whole table. Nothing outside this subpackage imports it.
"""
