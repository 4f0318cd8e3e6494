"""Operators for large-scale training data: mixing, decontamination, near duplicates, archives and more.

Nothing outside this subpackage imports it.
"""
