"""Operators for preparing training data: filters, deduplication, mixing, sharding, archives, tokens."""
