"""Operators of a training-data pipeline, each a function from ``DataFrame`` to ``DataFrame``.

Nothing else in the library imports this folder. ``queries`` registers one query per operator.
"""
