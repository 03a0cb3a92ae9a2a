"""Dataflow operators: deduplication, ordering, links, labels, merging and sampling."""
