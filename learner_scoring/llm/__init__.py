"""Corpus operators for training-data pipelines (dedup, sharding, mixing, tokens, extraction).

Nothing else in the package imports this subpackage; its queries are
registered by ``queries.py`` and its stages by ``corpus_pipeline.py``.
"""
