"""Operators of a training-data pipeline (quality, near duplicates, search, tokens, mixing).

Nothing else in the library imports this package; see ``queries.py`` for the registered queries.
"""
