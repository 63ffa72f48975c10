"""Operators of a training-data pipeline over documents, conversations, pages and embeddings.

Each module holds one operator with its own general interface; ``registry``
holds the thin queries that apply them to whole tables, and the SQL for those
that SQL can express.  Nothing else in the library imports this package.
"""
