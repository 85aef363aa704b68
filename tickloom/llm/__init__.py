"""Operators for training-data pipelines: one module for each, queries in ``queries``."""
