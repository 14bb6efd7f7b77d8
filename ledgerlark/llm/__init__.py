"""Operators that a large training-data pipeline needs, over a table of documents.

Nothing else in the library imports this subpackage.
"""
