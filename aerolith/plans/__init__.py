"""Queries over whole tables."""

from __future__ import annotations

from aerolith.plans import catalog, events, listings, pages, parsers, runs, sources


def all_queries():
    return dict(catalog.QUERIES)


def all_oracles():
    return dict(catalog.ORACLE)
