"""Operators of a training-data pipeline: filtering, dedup, mixing, tokens, search, fingerprints.

Nothing else in the library imports this subpackage; ``queries.py`` registers
its queries and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
