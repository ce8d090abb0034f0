"""Helpers for small results."""

from __future__ import annotations


def rows(df, *columns):
    """Sorted tuples of a small DataFrame."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
