"""Column functions and Python function hooks."""
