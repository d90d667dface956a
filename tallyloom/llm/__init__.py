"""Operators of a training-data pipeline: archives, deduplication, quality, sharding, token files, packing."""
