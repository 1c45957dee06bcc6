"""Operators of a large-scale training-data pipeline, each a Spark job over whole tables.

Nothing else in the library imports this subpackage.  ``queries`` registers one query per operator.
"""
