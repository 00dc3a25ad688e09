"""Operators for training data: deduplication, scoring, tokens and packing of documents."""
