"""Operators for large-scale training-data pipelines. Nothing outside this folder imports it."""
