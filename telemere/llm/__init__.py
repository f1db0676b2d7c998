"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing outside this subpackage imports it. ``queries`` registers one query for
each operator; ``corpus_pipeline.py`` at the repository's top chains five of them.
"""
