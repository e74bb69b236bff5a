"""Operators for preparing training corpora: filters, mixing, dedup, search, sharding, packing."""
