"""Operators for preparing training data: capture archives, quality, language, duplicates, contamination,
personal data, language-model scores, vector search, packing and sharding. ``queries`` registers them."""
