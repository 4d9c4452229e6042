"""Operators that prepare training text: one module each, with its query and SQL."""
