"""Scalar functions: lenient parsing, local civil time."""
