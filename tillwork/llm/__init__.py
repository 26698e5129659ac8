"""Operators of a training-data pipeline over text, URL and embedding tables."""
