"""Registered queries: name -> (plan, the same result in SQL or None)."""

from . import catalogue, documents, gap_scan, passages, retrieval, text

GROUPS = (text, documents, passages, catalogue, retrieval, gap_scan)


def all_queries() -> dict:
    found: dict = {}
    for group in GROUPS:
        found.update(group.QUERIES)
    return found
