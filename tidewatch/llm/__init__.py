"""Operators for training-data pipelines over a ``documents`` table."""
