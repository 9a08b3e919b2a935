"""Preparation of training text: duplicates, toxicity, retrieval, tokens, shards and packing."""
