"""Operators of a training-data pipeline, each with its own module and query."""
