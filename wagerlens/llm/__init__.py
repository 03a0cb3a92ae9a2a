"""Operators that a large text-corpus pipeline needs, one module each.

Nothing else in the library imports this subpackage; ``queries.py`` registers
the thin queries that apply each operator to its whole table.
"""
