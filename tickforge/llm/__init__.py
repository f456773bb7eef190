"""Operators for large training-data pipelines: archives, shards, scores, near copies, tokens."""
