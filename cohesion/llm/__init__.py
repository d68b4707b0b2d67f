"""Operators for building training corpora: extraction, tokens, quality, deduplication, packing."""
