"""Feature preparation, training, scoring and classification metrics."""
