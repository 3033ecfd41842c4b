"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries`` registers the thin
``opN_<name>`` queries that apply them to the driver's tables.
"""
