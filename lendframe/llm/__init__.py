"""Operators for large training corpora: deduplication, tokens, quality, extraction, search, archives."""
