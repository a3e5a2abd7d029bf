"""Stable keys built from natural-key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def natural_key(*parts) -> Column:
    """FN-10/FN-12: ``a,b|c`` style text key; NULL when any part is NULL
    (``concat`` semantics).  ``parts`` alternates columns and literal
    separators given as ``("sep", ",")`` tuples or plain strings."""
    cols = []
    for p in parts:
        if isinstance(p, tuple) and p[0] == "sep":
            cols.append(F.lit(p[1]))
        else:
            cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def location_key(lat, lon, tail) -> Column:
    """``lat,lon|tail`` (the weather hour and day keys)."""
    return F.concat(_c(lat).cast("string"), F.lit(","), _c(lon).cast("string"),
                    F.lit("|"), _c(tail).cast("string"))


def md5_hex(c) -> Column:
    """FN-11: TO_HEX(MD5(x)), lower-case hex."""
    return F.md5(_c(c))


def row_id(source, fetched_at) -> Column:
    """SNK-2: idempotency key ``source:fetched_at`` (ISO-8601 time)."""
    return F.concat(_c(source), F.lit(":"), iso_utc(fetched_at))


def iso_utc(ts) -> Column:
    """FN-21: ``datetime.isoformat()`` of an aware UTC time
    (``2024-01-02T03:04:05.123456+00:00``; no fraction when it is zero)."""
    t = _c(ts)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "SSSSSS")
    return F.concat(base, F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    F.lit("+00:00"))
