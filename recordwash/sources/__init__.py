"""Readers. Every one yields plain DataFrames with pushed-down filters and columns."""
