"""Compressed vectors: sixteen part codes each, from per-part codebooks.

A component becomes an integer, a vector is cut into equal parts, and every
part gets the index of its nearest codebook entry.  Distances come from value
dictionaries: for every dimension of a batch the squared differences of each
distinct integer to all entries are tabulated once, and the distance of a part
is a sum of rows gathered from these tables.

A pass over the vectors is one Spark job.  A round's tasks hand on the sums
and counts per entry, so what reaches the driver is one codebook (``ENTRIES``
entries), whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import materialise

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
CHUNK_ROWS = 4096   # vectors whose distances are held at once
HOT_SHARE = 1_000   # a label is hot when it holds over one in so many rows


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def bound(width: int) -> int:
    """Largest magnitude of an integer component for which summed squares of
    differences over ``width`` dimensions stay within 64 bits."""
    return math.isqrt(2 ** 62 // max(1, width)) // 2


def quantise(values: np.ndarray, width: int) -> np.ndarray:
    """Integers of flat float components, one row per vector."""
    top = bound(width)
    return np.clip(np.floor(SCALE * values), -top, top).astype(np.int64).reshape(-1, width)


def _dictionary(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of a dimension and each row's place among them."""
    low, high = int(column.min()), int(column.max())
    if high - low < 4 * len(column):
        return np.arange(low, high + 1), column - low
    return np.unique(column, return_inverse=True)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of ``book`` (ties: the lower) for each row,
    and its squared distance."""
    total = np.zeros((len(rows), len(book)), np.int64)
    for d in range(rows.shape[1]):
        values, codes = _dictionary(rows[:, d])
        table = (values[:, None] - book[:, d][None, :]) ** 2
        total += table[codes]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(rows)), best]


def _pieces(batch: pa.RecordBatch, width: int):
    """(first row, integer vectors) of consecutive slices of a batch; the
    batch's last column holds vectors of ``width`` components."""
    for at in range(0, batch.num_rows, CHUNK_ROWS):
        vectors = batch.column(batch.num_columns - 1).slice(at, CHUNK_ROWS)
        yield at, quantise(vectors.flatten().to_numpy(zero_copy_only=False), width)


def width_of(vectors: DataFrame) -> int | None:
    """The commonest vector length that ``PARTS`` divides (ties: the shorter)."""
    sizes = vectors.groupBy(F.size("vector").alias("w")).count().where((F.col("w") > 0) & (F.col("w") % PARTS == 0))
    top = sizes.orderBy(F.desc("count"), "w").first()
    return top.w if top else None


def _first_books(vectors: DataFrame, width: int) -> np.ndarray:
    """Codebooks (part, entry, position) of the smallest ids; rows with one id
    are ordered by their vectors, null ids come last."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(ENTRIES).collect()
    ints = quantise(np.array([r.vector for r in first], np.float64).reshape(-1), width)
    return ints.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2).copy()


def _improved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floored means of the parts nearest to them."""
    parts, entries, size = books.shape
    width = parts * size
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def sums(batches):
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            for _, ints in _pieces(batch, width):
                for p in range(parts):
                    part = ints[:, p * size:(p + 1) * size]
                    best, _ = nearest(part, shared.value[p])
                    count[p] += np.bincount(best, minlength=entries)
                    np.add.at(total[p], best, part)
        p, e, d = (x.ravel() for x in np.indices(total.shape))
        used = count[p, e] > 0
        p, e, d = p[used], e[used], d[used]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (p, e, d, count[p, e], total[p, e, d])], ["p", "e", "d", "n", "total"])

    found = vectors.select("vector").mapInArrow(sums, "p bigint, e bigint, d bigint, n bigint, total bigint")
    out = books.copy()
    for r in found.groupBy("p", "e", "d").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.p, r.e, r.d] = r.total // r.n
    return out


def train(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` rounds over all vectors of ``width`` components."""
    books = _first_books(vectors, width)
    for _ in range(rounds):
        books = _improved(vectors, books)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of vectors as wide as the codebooks."""
    parts, _, size = books.shape
    width = parts * size
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    digits = np.array([f"{i:02x}" for i in range(256)])
    kept = vectors.select("vec_id", "label", "vector")

    def codes(batches):
        for batch in batches:
            for at, ints in _pieces(batch, width):
                text, error = np.full(len(ints), "", object), np.zeros(len(ints), np.int64)
                for p in range(parts):
                    best, distance = nearest(ints[:, p * size:(p + 1) * size], shared.value[p])
                    text, error = text + digits[best].astype(object), error + distance
                rest = [batch.column(i).slice(at, len(ints)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(text.tolist(), pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    schema = StructType([*kept.schema.fields[:2], StructField("code", StringType()), StructField("error", LongType())])
    return kept.mapInArrow(codes, schema)


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all integers by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over the rows with an equal label (nulls count as
    equal).  Labels of over one in ``HOT_SHARE`` rows are at most that many:
    their sums are broadcast, and the other labels are joined by label."""
    sums = materialise(coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error")), "label_errors")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HOT_SHARE > rows
    per_hot = sums.where(hot).select(F.col("label").alias("k"), F.col("label_error"), F.lit(True).alias("hot"))
    per_rest = sums.where(~hot).select(F.col("label").alias("k"), "label_error")
    split = coded.join(F.broadcast(per_hot), F.col("label").eqNullSafe(F.col("k")), "left")
    out = ["vec_id", "code", "error", "label_error"]
    rest = split.where(F.col("hot").isNull()).drop("k", "hot", "label_error").join(per_rest, F.col("label").eqNullSafe(F.col("k")))
    return split.where(F.col("hot")).select(*out).unionByName(rest.select(*out))


def compressed(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold null, NaN or infinite components are left
    out.  The commonest length that 16 divides is the table's width; a vector
    of another length has neither code nor error and takes no part in the
    codebooks.  Components beyond ``bound`` (1.3e8 / 256 at 64 dimensions)
    count as the bound.  With fewer than 64 vectors the codebooks are as many
    entries long.  Rows with one id are taken in the order of their vectors,
    null ids after all others; repeated rows are coded one by one.  An empty
    table gives no rows; other columns are ignored.
    """
    rows = embeddings.select(embeddings["vec_id"], embeddings["label"], embeddings[vector].cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    width = width_of(rows)
    fits = F.size("vector") == F.lit(width if width else -1)
    others = rows.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    if width is None:
        return with_label_error(others).withColumn("codebooks_sha256", F.lit(codebooks_digest(np.zeros(0, np.int64))))
    books = train(rows.where(fits), width)
    coded = materialise(encode(rows.where(fits), books).unionByName(others), "vector_codes")
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
