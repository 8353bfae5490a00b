"""Operators for preparing training data: filters, deduplication, tokens, archives, shards."""
