"""Operators of a training-data pipeline (texts, pages, vectors, conversations).

Nothing else in the library imports this package; ``queries`` holds the
registered queries and their SQL.
"""
