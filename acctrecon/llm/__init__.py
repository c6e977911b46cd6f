"""Operators of a training-data pipeline: quality, dedup, archives, chat,
tokens, scoring, packing.  Nothing else in the library imports this package."""
