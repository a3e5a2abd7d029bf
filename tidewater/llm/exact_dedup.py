"""Exact dedup over an extendible-hash index on shared files.

Every distinct text (white space removed) is one index entry, addressed by the
leading bits of a 64-bit hash.  The directory starts with as many bits as the
number of keys asks for and doubles (one more bit) while a bucket holds more
keys than ``capacity``; only overfull buckets split, so a bucket has a local
depth of its own.

A cell of the starting directory is a range of keys and owns the buckets split
from it.  Texts travel to the owner of their cell; its task compares their
bytes, chains different texts of one hash and writes the entries with their
buckets.  A document finds its verdict through the directory: from its hash to
its cell, bucket and chain.

Only DataFrame functions run here.  Texts of keys that hold more than one row
in ``HOT_SHARE`` collapse in a map-side grouping first, so that a text that
makes up a third of all rows reaches its owner as one row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WHITESPACE, discard, materialise, row_hash, whole_text

BUCKET_KEYS = 1024         # keys a bucket holds before it splits
HOT_SHARE = 1000           # a key with more than one row in so many collapses before it travels
BROADCAST_BUCKETS = 200_000  # a directory of more buckets is joined by cell

# A row's rank packs (code points, reversed doc_id) into one decimal, which a
# hash aggregate can take the maximum of in place.
_SPAN = Decimal(2**66)
_NULL_ID = Decimal(2**65)
_SHIFT = Decimal(2**63)


def normalised(text: Column | str = "text") -> Column:
    """The text without white space characters; null counts as empty."""
    out = whole_text(text)
    for ch in WHITESPACE:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _rank(text: Column, doc_id: Column) -> Column:
    back = F.coalesce(doc_id.cast("decimal(20,0)") + F.lit(_SHIFT), F.lit(_NULL_ID))
    return (F.length(text).cast("decimal(12,0)") * F.lit(_SPAN) + (F.lit(_NULL_ID) - back)).cast("decimal(38,0)")


def _points_of(rank: Column) -> Column:
    return F.floor(rank / F.lit(_SPAN)).cast("bigint")


def _id_of(rank: Column) -> Column:
    back = F.lit(_NULL_ID) - rank % F.lit(_SPAN)
    return F.when(back < F.lit(_NULL_ID), (back - F.lit(_SHIFT)).cast("bigint"))


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def key_counts(docs: DataFrame, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """key and n (rows) of every hash of a normalised text."""
    return docs.select(key(normalised()).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def split_directory(keys: DataFrame, capacity: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The directory (cell, bucket, depth) over distinct ``keys`` and its
    starting depth.  It doubles until no bucket has more than ``capacity`` keys
    (or the hash has no bits left; equal keys share a chain anyway).  A prefix
    is a bucket if it fits and the one it was split from did not."""
    start = depth = max(0, math.ceil(math.log2(max(1, keys.count()) / capacity)))
    levels = None
    while True:
        sizes = keys.groupBy(_prefix(F.col("key"), depth).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        over = F.col("n") > (capacity if depth < 63 else 2**62)
        if depth > start:
            halves = F.collect_list(F.struct("bucket", "n"))  # two at most
            sizes = (sizes.groupBy(F.shiftrightunsigned("bucket", 1)).agg(F.sum("n").alias("both"), halves.alias("halves"))
                     .where(F.col("both") > capacity).select(F.inline("halves")))
        cell = F.shiftrightunsigned("bucket", depth - start).cast("bigint")
        fits = sizes.where(~over).select(cell.alias("cell"), "bucket", F.lit(depth).alias("depth"))
        levels = fits if levels is None else levels.union(fits)
        if sizes.where(over).isEmpty():
            return levels, start
        depth += 1


def located(rows: DataFrame, directory: DataFrame, start: int) -> DataFrame:
    """``rows`` (with a column key) with the cell, bucket and depth of their
    keys, which must be in the directory."""
    at = F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(F.expr("shiftrightunsigned(key, 64 - depth)"))
    small = directory.limit(BROADCAST_BUCKETS + 1).count() <= BROADCAST_BUCKETS
    rows = rows if "cell" in rows.columns else rows.withColumn("cell", _prefix(F.col("key"), start))
    return rows.join(F.broadcast(directory) if small else directory, "cell").where(at == F.col("bucket"))


def owned_texts(docs: DataFrame, keys: DataFrame, start: int, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per distinct normalised text, in the task that owns its cell:
    cell, key, text_sha256, rank of the row that stays, group_size.  ``keys``
    are the counts of ``docs``.  Grouping by the text compares bytes."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(keys.where(F.col("n") * HOT_SHARE > total).select("key"))  # fewer than HOT_SHARE rows
    rows = (docs.select("doc_id", whole_text().alias("text"))
            .select(normalised(F.col("text")).alias("norm"), _rank(F.col("text"), F.col("doc_id")).alias("rank"))
            .select(key(F.col("norm")).alias("key"), "norm", "rank", F.lit(1).cast("bigint").alias("n")))
    collapsed = (rows.join(hot, "key", "left_semi").groupBy("key", "norm")
                 .agg(F.max("rank").alias("rank"), F.sum("n").alias("n")))
    return (rows.join(hot, "key", "left_anti").union(collapsed)
            .withColumn("cell", _prefix(F.col("key"), start)).repartition("cell")
            .groupBy("cell", "key", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("group_size"))
            .select("cell", "key", F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"), "rank", "group_size"))


def _indexed(docs: DataFrame, capacity: int, key: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame, int]:
    keys = materialise(key_counts(docs, key), "dedup-keys")
    directory, start = split_directory(keys, capacity)
    directory = materialise(directory, "dedup-directory")
    chain = F.row_number().over(Window.partitionBy("cell", "key").orderBy("text_sha256"))
    index = materialise(
        located(owned_texts(docs, keys, start, key).withColumn("chain", chain), directory, start)
        .select("key", "bucket", "depth", "chain", "text_sha256", _id_of(F.col("rank")).alias("keep_id"),
                _points_of(F.col("rank")).alias("keep_points"), "group_size")
        .withColumn("place", F.shiftrightunsigned("key", 1)).sortWithinPartitions("place", "chain").drop("place"), "dedup-index")
    discard(keys)
    return index, directory, start


def build_index(docs: DataFrame, capacity: int = BUCKET_KEYS, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Write the index below the shared folder and return it: key, bucket,
    depth, chain (place among colliding texts), text_sha256, keep_id,
    keep_points, group_size.  A file holds the cells of one owner task, in
    order of their keys; a bucket lies in one file."""
    return _indexed(docs, capacity, key)[0]


def exact_groups(docs: DataFrame, capacity: int = BUCKET_KEYS, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty (empty texts are one group).  Of equal texts the
    row with the most code points in its original text, then the smallest
    doc_id stays; a null doc_id comes after all others and its keep_id is null
    if it stays.  Rows that repeat a doc_id with an equal text of equal length
    share one verdict.  Other columns are ignored; an empty table gives none.
    """
    index, directory, start = _indexed(docs, capacity, key)
    rows = (docs.select("doc_id", whole_text().alias("text"))
            .select("doc_id", F.length("text").alias("points"), normalised(F.col("text")).alias("norm"))
            .select("doc_id", "points", key(F.col("norm")).alias("key"), F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256")))
    return (located(rows, directory, start).drop("cell").join(index.drop("chain"), ["bucket", "depth", "key", "text_sha256"])
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
                    "text_sha256"))


def drop_copies(docs: DataFrame, capacity: int = BUCKET_KEYS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; of rows
    repeated with one doc_id and equal text, the one with the smallest hash of
    the whole row.  Null texts count as empty, null ids come last, an empty
    table gives none."""
    index = build_index(docs, capacity).select(
        F.col("key").alias("k"), F.col("text_sha256").alias("sha"), F.col("keep_id").alias("id"), F.col("keep_points").alias("points"))
    norm = normalised(F.col("row.text"))
    rows = docs.select(F.struct("*").alias("row"), row_hash(docs).alias("_tie")).select(
        "row", "_tie", F.xxhash64(norm).alias("_k"), F.sha2(F.encode(norm, "UTF-8"), 256).alias("_sha"),
        F.col("row.doc_id").alias("_id"), F.length(whole_text(F.col("row.text"))).cast("bigint").alias("_points"))
    # The key holds the doc_id, so a large group spreads over all tasks.
    kept = rows.join(index, (F.col("_k") == F.col("k")) & (F.col("_sha") == F.col("sha"))
                     & F.col("_id").eqNullSafe(F.col("id")) & (F.col("_points") == F.col("points")), "left_semi")
    return kept.groupBy("_k", "_sha", "_id", "_points").agg(F.min_by("row", "_tie").alias("row")).select("row.*")
