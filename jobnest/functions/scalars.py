"""Scalar helpers E3-E14 as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strict_long(col: str | Column, what: str = "value") -> Column:
    """Text -> integer that fails the job on bad text *and* on NULL.

    ANSI ``cast`` already raises on bad text; NULL passes a cast, so NULL is
    turned into an error first (the reference's ``astype(int)`` raises on both).
    ``CASE WHEN c IS NULL THEN raise_error`` survives constant folding.
    """
    c = _c(col)
    return require(c, f"NULL {what} cannot be cast to an integer").cast("bigint")


def require(col: str | Column, message: str) -> Column:
    """The value itself, or a job failure with ``message`` when it is NULL (X3 fail-fast)."""
    c = _c(col)
    return F.when(c.isNull(), F.raise_error(F.lit(message))).otherwise(c)


def strict_int(col: str | Column, what: str = "value") -> Column:
    """E3 alias: the reference's ``astype('int')`` is a 64-bit integer."""
    return strict_long(col, what)


def dotted_component(col: str | Column, index: int = 1, strict: bool = True) -> Column:
    """``'a.b.c'`` -> ``'b'``.  Strict form raises when the part is missing."""
    parts = F.split(_c(col), r"\.")
    if strict:
        return F.element_at(parts, index + 1)  # ANSI: out of range raises
    return F.get(parts, index)


def url_key(base: str, id_col: str | Column) -> Column:
    """E5: ``base/{int(id)}`` (number -> integer -> text)."""
    return F.concat_ws("/", F.lit(base), _c(id_col).cast("double").cast("bigint").cast("string"))


def split_list_param(value: str, sep: str = ", ") -> Column:
    """A comma-space separated setting as an array literal column."""
    return F.split(F.lit(value), sep, -1)


def translate_name(col: str | Column) -> Column:
    """Spaces -> underscores (group names), drop ``[`` and ``]``."""
    return F.translate(F.regexp_replace(_c(col), " ", "_"), "[]", "")


def day_before(run_date: str | dt.date) -> Column:
    """Run date minus one day."""
    return F.date_sub(F.lit(str(run_date)).cast("date"), 1)


def month_before(run_date: str | dt.date) -> Column:
    """The same day one month earlier (calendar-aware, unlike replacing '05' by '04' in the text)."""
    return F.add_months(F.lit(str(run_date)).cast("date"), -1)


def audit_timestamp(run_ts: str | dt.datetime) -> Column:
    """One TIMESTAMP instant for the whole load (never current_timestamp())."""
    if isinstance(run_ts, dt.datetime):
        run_ts = run_ts.isoformat(sep=" ")
    return F.lit(str(run_ts)).cast("timestamp")


def render_in_zone(ts: str | Column, zone: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """E11 (display only): an instant as wall-clock text in a named zone.

    The stored value stays the instant; the zone is applied only to the rendered text.
    """
    utc_wall = F.to_utc_timestamp(_c(ts), F.current_timezone())   # session-zone wall clock -> UTC wall clock
    return F.date_format(F.from_utc_timestamp(utc_wall, zone), fmt)


# Fixed values (must equal the original's): insert date, update date, active and deleted flag of a clean row.
BOOKKEEPING = ("md_ins_date", "md_upd_date", "md_is_activ", "md_is_delete")


def bookkeeping_columns(run_date: str | dt.date) -> list[Column]:
    """md_* bookkeeping columns (insert/update date, active and deleted flags)."""
    d = F.lit(str(run_date)).cast("date")
    return [c.alias(n) for c, n in zip([d, d, F.lit(1), F.lit(0)], BOOKKEEPING)]
