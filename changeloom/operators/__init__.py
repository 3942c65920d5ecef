"""Operators: each is a function ``DataFrame -> DataFrame`` (or a pair)."""
