"""Operators of a training-data pipeline (documents, embeddings, pages).

Each module holds one operator with a general interface; ``queries`` derives
the registered ``opN_*`` queries from them. Nothing else in the library
imports this package.
"""
