"""Incremental forms of the batch plans."""
