"""Rows of a DataFrame for comparison in tests."""

from __future__ import annotations


def rows(df, *order):
    """Collected rows as tuples, ordered."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
