"""Readers and adapters that give the engine its domain tables."""
