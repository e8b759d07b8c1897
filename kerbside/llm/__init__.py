"""Operators for preparing training text; `queries` holds the named queries built on them."""
