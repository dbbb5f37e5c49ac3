"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this package; ``llm.queries`` registers
its queries and their SQL.
"""
