"""Operators of a training-data pipeline: text in, one row per document (or page) out.

Nothing else in the library imports this package.
"""
