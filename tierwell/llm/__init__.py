"""Operators for building text corpora (deduplication, filtering, tokenising, sharding)."""
