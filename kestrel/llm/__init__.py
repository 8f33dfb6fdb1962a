"""Operators for training-data pipelines, one module per operator.

Nothing outside this package imports it. ``kestrel.llm.queries`` holds the
registered queries and their SQL.
"""
