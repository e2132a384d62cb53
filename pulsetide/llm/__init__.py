"""Operators that prepare training data: one module each, with their queries and SQL beside them."""
