"""Corpus operators for training data: counting, matching, scoring and packing of documents."""
