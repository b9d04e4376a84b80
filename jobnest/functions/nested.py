"""Strict / lenient access to nested fields.

Lenient access is plain struct navigation (NULL-propagating).  Strictness is
expressed as a boolean *validity flag* next to the value, which the error
operators (X1 page abort, X2 quarantine) consume.  Every flag is wrapped in
``coalesce(..., true/false)`` because under ANSI ``size(NULL) > 0`` is NULL and
a NULL flag would drop a row from both the good and the bad output.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(cond: Column, default: bool = False) -> Column:
    return F.coalesce(cond, F.lit(default))


def first_id(arr: str | Column, field: str = "id") -> Column:
    """First element's field; NULL for a NULL or empty list."""
    return F.get(_c(arr), 0)[field]


def first_nested_id(arr: str | Column, inner: str, field: str = "id") -> Column:
    """First element's ``inner.field`` (e.g. ``languages[0].level.id``)."""
    return F.get(_c(arr), 0)[inner][field]


def pluck(arr: str | Column, field: str) -> Column:
    """Array of structs -> array of one field (plain field extraction, no lambda)."""
    return _c(arr)[field]


def all_present(arr: str | Column, field: str) -> Column:
    """True when every element exists and carries a non-NULL ``field``."""
    return flag(F.forall(_c(arr), lambda x: x.isNotNull() & x[field].isNotNull()), True)
