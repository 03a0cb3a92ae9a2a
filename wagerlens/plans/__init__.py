"""Declarative feature plans and the scenarios that combine them."""
