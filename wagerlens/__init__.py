"""Batch analytics over per-player event data, expressed with Spark DataFrames."""
