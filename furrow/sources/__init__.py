"""Readers, optional page recovery, embedding back ends and table sinks."""
