"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it.  One module per operator;
``catalog`` holds the registered queries and ``oracle`` their SQL.
"""
