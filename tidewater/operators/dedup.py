"""Newest-wins deduplication (ROW_NUMBER ... = 1) and its generic form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_RN = "__rn"


def _order(spec) -> Column:
    """``'col'``, ``'col desc'``, ``'col asc'`` or a Column -> sort Column.
    NULLs sort last in both directions, so a NULL never wins a tie."""
    if isinstance(spec, Column):
        return spec
    parts = spec.strip().split()
    name = parts[0]
    direction = parts[1].lower() if len(parts) > 1 else "asc"
    if direction not in ("asc", "desc"):
        raise ValueError(f"bad order spec {spec!r}")
    return F.col(name).desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last()


def parse_order_by(order_by) -> list[Column]:
    if isinstance(order_by, str):
        order_by = [p for p in order_by.split(",") if p.strip()]
    return [_order(o) for o in order_by]


def rank_within(df: DataFrame, partition_by, order_by, name: str = "rn") -> DataFrame:
    """WIN-1: ``ROW_NUMBER() OVER (PARTITION BY ... ORDER BY ...)`` as a column."""
    keys = [F.col(k) if isinstance(k, str) else k for k in partition_by]
    w = Window.partitionBy(*keys).orderBy(*parse_order_by(order_by))
    return df.withColumn(name, F.row_number().over(w))


def rank_spread(df: DataFrame, partition_by, order_by, name: str = "rn", ranges: int | None = None) -> DataFrame:
    """WIN-1 for hot keys: the numbers of ``rank_within``, with a key's rows
    numbered in many tasks.

    The rows are written below the shared folder in ranges of (key, order), so
    a key that exceeds one range goes on in the next.  A row's number is its
    place among its key's rows of one file, plus the rows of that key in the
    files before.  At most one key goes on from one file to the next, so the
    counts to add are fewer than the files; they are broadcast.  ``order_by``
    should be total: rows that agree in all of it cannot be spread.  Written
    files outlive lost executors and make the ranges final.  ``ranges`` fixes
    their number; by default adaptive execution merges small ones."""
    cols = df.columns
    part, place, key, before = "__part", "__place", "__key", "__before"
    keys = [F.col(k) if isinstance(k, str) else k for k in partition_by]
    order = [F.col(key), *parse_order_by(order_by)]
    path = scratch_path(df.sparkSession, "rank")
    keyed = df.withColumn(key, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    split = [ranges, *order] if ranges else order
    keyed.repartitionByRange(*split).sortWithinPartitions(*order).write.parquet(path)
    stored = df.sparkSession.read.schema(keyed.schema).parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    rows = stored.select(*cols, key, number.alias(part), F.col("_metadata.row_index").alias(place))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(key, part).agg(F.count(F.lit(1)).alias("n"))
    carried = counts.withColumn(before, F.sum("n").over(earlier)).where(F.col(before) > 0).drop("n")
    carried = carried.select(F.col(key).alias("__k"), F.col(part).alias("__p"), before)
    local = F.row_number().over(Window.partitionBy(key, part).orderBy(place))
    joined = rows.withColumn(name, local).join(F.broadcast(carried), F.col(key).eqNullSafe(F.col("__k")) & (F.col(part) == F.col("__p")), "left")
    return joined.select(*cols, (F.col(name) + F.coalesce(before, F.lit(0))).alias(name))


def deduplicate(df: DataFrame, partition_by, order_by) -> DataFrame:
    """WIN-2 / TOP-1: keep the first row per ``partition_by`` under
    ``order_by``; returns the input columns only (``* EXCEPT(rn)``).

    Planned as Window + ``rn = 1``; Catalyst turns it into a WindowGroupLimit
    that already keeps one row per key inside every map task, so a key that
    repeats on many rows ships at most one row per task through the shuffle.
    """
    cols = df.columns
    ranked = rank_within(df, partition_by, order_by, _RN)
    return ranked.where(F.col(_RN) == 1).select(*cols)


def total_order(df: DataFrame, first, exclude=()) -> list:
    """``first`` then every remaining column ascending: a total tie-break so
    newest-wins never picks an arbitrary row."""
    used = {(o.split()[0] if isinstance(o, str) else None) for o in first}
    rest = [c for c in df.columns if c not in used and c not in exclude]
    return list(first) + rest
