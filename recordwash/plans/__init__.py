"""Whole jobs over a batch of input."""
