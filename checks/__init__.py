"""Checked queries: every operator on the driver's tables, with SQL that computes the same."""

from __future__ import annotations


def load():
    """All queries and all reference SQL, by name."""
    from . import extract, functions, ingest, jobs, mapping, reshape, serve  # noqa: F401
    from .kit import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
