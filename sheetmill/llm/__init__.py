"""Operators for preparing large text corpora and embeddings."""
