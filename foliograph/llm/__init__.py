"""Operators for preparing model training text. Nothing outside this package imports it."""
