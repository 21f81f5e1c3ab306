"""Operators for training data: scoring, deduplication, formatting, filtering, mixing and packing.

Nothing else in the library imports this package.
"""
