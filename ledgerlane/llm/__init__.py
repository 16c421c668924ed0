"""Operators of a training-data pipeline, each over a whole table."""
