"""Operators of a pipeline for training data: text scoring, deduplication, tokens, packing, archives and vector search."""
