"""Operators for training-data pipelines; each module is one operator, queries.py registers them."""
