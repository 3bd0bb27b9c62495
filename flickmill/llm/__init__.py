"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage. ``registry.QUERIES`` holds
its queries, ``registry.SQL`` the DuckDB twins.
"""
