"""Operators of a training-data pipeline over documents, pages and embeddings.

Each module holds one operator (a general DataFrame -> DataFrame function) and
the thin ``opN_*`` query that applies it to its whole table.  ``registry``
collects the queries.  Nothing outside this package imports it.
"""
