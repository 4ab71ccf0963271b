"""Operators for large training corpora: deduplication, filters, tokens, mixing, archives and search."""
