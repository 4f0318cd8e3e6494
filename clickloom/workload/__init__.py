"""Registered queries over the given tables, and the SQL twins they are checked against."""
