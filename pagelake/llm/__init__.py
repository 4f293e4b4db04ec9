"""Operators of a training-data pipeline (tokens, archives, deduplication, classifiers, packing).

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and ``corpus_pipeline.py`` at the repository top chains five.
"""
