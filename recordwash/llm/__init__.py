"""Operators for training-data pipelines: documents, tokens, benchmarks and web pages."""
