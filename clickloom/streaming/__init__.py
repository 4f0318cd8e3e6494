"""Aggregates over growing folders of files."""
