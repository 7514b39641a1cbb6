"""Operators for preparing training text: near-duplicates, tokens, quality, packing, extraction, sharding."""
