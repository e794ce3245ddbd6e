"""Operators for preparing training text (optional subpackage)."""
