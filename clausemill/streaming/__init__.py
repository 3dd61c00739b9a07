"""Incremental extraction."""
