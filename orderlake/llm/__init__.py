"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing else in the library imports this package. Each module holds one
operator with a general interface; ``queries`` applies them with production
parameters to the given tables.
"""
