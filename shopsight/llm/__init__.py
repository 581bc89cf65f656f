"""Operators for training-data pipelines: scans, deduplication, classifiers, sharding, archives, packing."""
