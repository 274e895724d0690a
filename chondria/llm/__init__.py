"""Operators for preparing training text: de-duplication, tokens, quality, archives, scores, mixing, private data."""
