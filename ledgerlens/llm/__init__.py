"""Operators for preparing training text: filters, near-copy search, mixing, sharding, token files.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
