"""Operators of a training-data pipeline over tables of documents and embeddings.

Nothing else in the library imports this subpackage.
"""
