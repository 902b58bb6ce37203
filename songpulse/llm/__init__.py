"""Operators for training-data pipelines over the corpus tables."""
