"""Queries on the driver's tables."""

from __future__ import annotations

import importlib

_MODULES = ("relational_queries", "rule_queries", "merge_queries", "match_queries", "job_queries", "listing_queries")


def registry():
    """All registered queries by name."""
    for name in _MODULES:
        importlib.import_module(f"listingflow.queries.{name}")
    from listingflow.queries.base import QUERIES

    return QUERIES
