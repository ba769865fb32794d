"""Cleansing and de-duplication of semi-structured legal records on Spark."""
