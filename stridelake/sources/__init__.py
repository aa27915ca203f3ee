"""Sources of the ordered-sequence engine."""
