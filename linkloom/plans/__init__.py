"""Derived corpora, the named queries and their SQL twins."""
