"""Operators of the ordered-sequence engine."""
