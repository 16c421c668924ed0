"""Relational building blocks used by several jobs."""
