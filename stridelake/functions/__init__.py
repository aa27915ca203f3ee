"""Functions of the ordered-sequence engine."""
