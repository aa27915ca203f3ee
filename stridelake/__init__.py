"""Ordered-sequence analytics and training-data operators as Spark DataFrame transformations."""
