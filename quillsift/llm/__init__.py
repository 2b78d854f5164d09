"""Operators of a training-data pipeline: text to tokens, filters, deduplication, shards, search."""
