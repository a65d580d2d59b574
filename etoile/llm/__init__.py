"""Operators of a training-data pipeline: cleaning, deduplication, selection, tokens, search.

Nothing else in the library imports this subpackage. Each module holds one operator with its
own interface; ``queries`` wraps them as registered queries over whole tables.
"""
