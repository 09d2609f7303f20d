"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it; ``queries.py`` registers one query
per operator.
"""
