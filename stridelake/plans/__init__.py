"""Plans of the ordered-sequence engine."""
