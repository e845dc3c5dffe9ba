"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is present.
"""
