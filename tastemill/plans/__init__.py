"""Registered queries over the given tables, each next to its check SQL."""
