"""Time helpers and parameter fallbacks.  Every "now" is a parameter so a
run is reproducible; ``None`` means the query start time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import iso_utc


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def now_or(as_of=None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def utc_stamp(ts=None) -> Column:
    """FN-21: ISO-8601 UTC time text."""
    return iso_utc(now_or(ts))


def compact_stamp(ts=None) -> Column:
    """FN-21: ``yyyyMMdd'T'HHmmss'Z'``."""
    return F.date_format(now_or(ts), "yyyyMMdd'T'HHmmss'Z'")


def yesterday(as_of=None) -> Column:
    """FN-22: the UTC date before ``as_of`` as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_sub(F.to_date(now_or(as_of)), 1), "yyyy-MM-dd")


def fallback(*candidates, empty_is_missing: bool = True) -> Column:
    """FN-25: Python ``a or b or c``: the first candidate that is present
    (and, by default, not the empty string)."""
    cols = []
    for c in candidates:
        c = c if isinstance(c, Column) else F.lit(c)
        cols.append(F.nullif(c, F.lit("")) if empty_is_missing else c)
    return F.coalesce(*cols)
