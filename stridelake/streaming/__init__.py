"""Streaming of the ordered-sequence engine."""
