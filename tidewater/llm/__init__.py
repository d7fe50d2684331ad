"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Nothing else in the library imports this subpackage; ``catalog`` registers
one query per operator and ``corpus_pipeline.py`` chains five of them.
"""
