"""Operators of a training-data pipeline (deduplication, tokenising, scoring, archives).

Nothing else in the library imports this subpackage.
"""
