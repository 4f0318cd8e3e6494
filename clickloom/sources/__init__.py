"""Readers, the feature store and the sinks."""
