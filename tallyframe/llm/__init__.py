"""Operators for preparing training text: filters, deduplication, sharding, tokens, archives.

Nothing else in the library imports this package; ``queries`` holds its registered queries.
"""
