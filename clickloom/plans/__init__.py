"""Composed feature groups, training and forecasting: the user-level API."""
