"""Row filters from the staging models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """FLT-1: ``col LIKE pattern`` (NULL drops)."""
    return df.where(F.col(col).like(pattern))


def where_equal(df: DataFrame, col: str, value) -> DataFrame:
    """FLT-2: ``col = value``; NULL compares unknown and drops."""
    return df.where(F.col(col) == F.lit(value))


def where_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """FLT-4 / FLT-7: drop rows with a NULL in any of ``cols``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def where_rank_one(df: DataFrame, rank_col: str = "rn") -> DataFrame:
    """FLT-3 + PRJ-2: ``WHERE rn = 1`` then ``* EXCEPT(rn)``."""
    return df.where(F.col(rank_col) == 1).drop(rank_col)
