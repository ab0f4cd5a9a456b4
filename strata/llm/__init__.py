"""Operators for preparing training data: filters, deduplication, mixing, tokenisation.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``queries.py`` holds the thin queries
over the given tables.
"""
