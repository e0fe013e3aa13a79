"""Operators for preparing training corpora: deduplication, screening, mixing, tokenising.

Each module holds one operator with a general interface; ``queries`` registers the thin queries
over the given tables. Nothing outside this package imports it (``corpus_pipeline.py`` counts as
part of it).
"""
