"""Incremental maintenance of derived tables."""
