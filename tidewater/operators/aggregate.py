"""Grouped statistics (partial aggregation before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_stats(df: DataFrame, keys, value: str, stats=("count", "avg", "min", "max"),
                prefix: str = "", avg_digits: int | None = 6) -> DataFrame:
    """AGG-1..4 + AGG-6: ``count(*)`` (rows, NULL values included) and
    avg/min/max of ``value`` (NULLs skipped) per ``keys``.  Averages leave
    as DOUBLE rounded to ``avg_digits``; min/max as DOUBLE."""
    out = []
    for s in stats:
        if s == "count":
            out.append(F.count(F.lit(1)).alias(f"{prefix}count"))
        elif s == "avg":
            a = F.avg(value).cast("double")
            out.append((F.round(a, avg_digits) if avg_digits is not None else a).alias(f"{prefix}avg"))
        elif s == "min":
            out.append(F.min(value).cast("double").alias(f"{prefix}min"))
        elif s == "max":
            out.append(F.max(value).cast("double").alias(f"{prefix}max"))
        else:
            raise ValueError(s)
    return df.groupBy(*keys).agg(*out)


def distinct_per_group(df: DataFrame, keys, col: str, name: str = "n_distinct") -> DataFrame:
    """AGG-5: ``count(distinct col)`` per ``keys`` (planned as a two-level
    aggregate: first on (keys, col), then on keys)."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(name))
