"""Interleave sources to target weights by Pfair scheduling.

A source's documents form blocks.  Block j of a source with weight a / period
is released at slot floor(j * period / a) and due by slot
ceil((j + 1) * period / a).  Taking the released block with the earliest
deadline in every slot keeps each source within less than one block of its
share.  Integer weights make the order repeat after ``period`` slots, so one
period is worked out (its length depends on the number of sources, never on
the rows) and every block's slot follows from it by arithmetic.  Target weights
are rounded by largest remainders, so over a period every source is within one
block of its unrounded share as well.

Documents are numbered within their source without sorting a source in one
task: ranges of a hash of doc_id are counted, and a row's number is the count
of the ranges before its own plus its place in the range.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, row_hash

BLOCK_DOCS = 8        # documents of a block
RESOLUTION = 1000     # slots of a period, about; more with many sources
SOURCE_SLOTS = 20     # slots of a period for each source, at least
MAX_SOURCES = 100_000  # sources are categories; more of them is an input error
MAX_PERIOD = SOURCE_SLOTS * MAX_SOURCES  # longer periods of given weights are shortened
BROADCAST_SLOTS = 200_000  # a schedule up to this length is broadcast
RANGE_ROWS = 256      # documents numbered together, about

# Multipliers of the id hash (fixed values: 2^32 over the golden ratio, and a
# prime of similar size).
_GOLDEN = 2654435761
_PRIME = 2246822519


def order_hash(doc_id: str = "doc_id", otherwise: Column | None = None):
    """32 bits that spread ids evenly, whichever of their bits vary; for a null
    id those of ``otherwise`` (0)."""
    n = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0) if otherwise is None else otherwise)
    half = lambda bits, by: F.pmod(F.pmod(bits, F.lit(1 << 31)) * F.lit(by), F.lit(1 << 32))
    return F.pmod(half(n, _GOLDEN) + half(F.shiftright(n, 31), _PRIME), F.lit(1 << 32))


def apportioned(shares: dict[str, float], slots: int) -> dict[str, int]:
    """Integer weights for positive ``shares`` that add up to ``slots``, by
    largest remainders (ties by name); a weight of none is lifted to one."""
    total = sum(v for _, v in sorted(shares.items()))
    exact = {s: slots * v / total for s, v in shares.items()}
    out = {s: int(x) for s, x in exact.items()}
    rest = slots - sum(out.values())
    for s in sorted(exact, key=lambda s: (out[s] - exact[s], s))[:rest]:
        out[s] += 1
    return {s: max(1, a) for s, a in out.items()}


def resolution(sources: int) -> int:
    """Slots of a period."""
    return max(RESOLUTION, SOURCE_SLOTS * sources)


def default_weights(sizes: dict[str, int]) -> dict[str, int]:
    """Weights after the square root of the sizes: large sources are damped and
    small ones lifted."""
    return apportioned({s: n ** 0.5 for s, n in sizes.items()}, resolution(len(sizes))) if sizes else {}


def one_period(weights: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) over one period, by earliest
    deadline first among released blocks; ties go by the source's name."""
    period = sum(weights.values())
    release = lambda s, j: j * period // weights[s]
    deadline = lambda s, j: -(-(j + 1) * period // weights[s])
    waiting = [(0, s, 0) for s in weights]  # (release, source, block)
    heapq.heapify(waiting)
    ready, out = [], []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(s, j), s, j))
        due, s, j = heapq.heappop(ready)
        out.append((s, j, slot, release(s, j), due))
        if j + 1 < weights[s]:
            heapq.heappush(waiting, (release(s, j + 1), s, j + 1))
    return out


def _numbered(rows: DataFrame, total: int) -> DataFrame:
    """Add ``place``, the 0-based number of a row in its source (column _s) by
    (_h, _id, _tie): ranges of about RANGE_ROWS rows are numbered apart, and running
    counts of the ranges are summed in two levels."""
    bits = min(32, max(0, math.ceil(math.log2(max(1, total) / RANGE_ROWS))))
    cell = F.shiftright("_h", 32 - bits)
    counted = (rows.groupBy("_s", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("_part", F.shiftright("_cell", bits // 2)))
    counted = materialise(counted, "mixing-cells")
    before = lambda by, order: F.coalesce(
        F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counted.groupBy("_s", "_part").agg(F.sum("n").alias("n")).withColumn("_base", before(["_s"], "_part")).drop("n")
    cells = (counted.withColumn("_in", before(["_s", "_part"], "_cell")).join(parts, ["_s", "_part"])
             .select("_s", "_cell", (F.col("_base") + F.col("_in")).alias("_before")))
    within = F.row_number().over(Window.partitionBy("_s", "_cell").orderBy("_h", "_id", "_tie"))
    return (rows.withColumn("_cell", cell).join(cells, ["_s", "_cell"])
            .withColumn("place", F.col("_before") + within - 1))


def _null_hash(docs: DataFrame) -> Column:
    """What spreads rows without an id: their length, where the table has it."""
    return F.xxhash64("n_chars") if "n_chars" in docs.columns else F.lit(0).cast("bigint")


def _scheduled(docs: DataFrame, weights: dict[str, int] | None, block_docs: int, *keep: str) -> DataFrame:
    """``keep`` plus source name, block, slot, release, deadline and place of
    each row of ``docs`` (doc_id, source, _none, _tie)."""
    spark = docs.sparkSession
    sizes = {r["_s"]: r["count"] for r in docs.groupBy(F.coalesce("source", F.lit("")).alias("_s")).count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    chosen = {s: (weights or {}).get(s, 1) for s in sizes} if weights else default_weights(sizes)
    if any(a < 1 for a in chosen.values()):
        raise ValueError("weights are whole numbers of at least 1")
    if sum(chosen.values()) > MAX_PERIOD:
        chosen = apportioned(chosen, MAX_PERIOD // 2)
    period = sum(chosen.values())
    plan = spark.createDataFrame([(s, j, slot, chosen[s]) for s, j, slot, _, _ in one_period(chosen)],
                                 "_s string, _j bigint, _slot bigint, _a bigint")
    rows = docs.select(*keep, F.coalesce("source", F.lit("")).alias("_s"), order_hash("doc_id", F.col("_none")).alias("_h"), F.col("doc_id").alias("_id"), "_tie")
    rows = _numbered(rows, sum(sizes.values())).withColumn("block", F.expr(f"place div {block_docs}"))
    # One row per source, MAX_SOURCES at most, and one per slot of a period; a
    # long schedule is joined by (source, block), which spreads rows evenly.
    weight = F.broadcast(plan.select("_s", "_a").distinct())
    rows = rows.join(weight, "_s").withColumn("_j", F.pmod("block", "_a"))
    turns = plan.select("_s", "_j", "_slot")
    rows = rows.join(F.broadcast(turns) if period <= BROADCAST_SLOTS else turns, ["_s", "_j"])
    turn = F.expr(f"(block div _a) * {period}L")
    return rows.select(
        *keep, "_s", "block", (turn + F.col("_slot")).alias("slot"), F.expr(f"(block * {period}L) div _a").alias("release"),
        F.expr(f"((block + 1) * {period}L + _a - 1) div _a").alias("deadline"), "place")


def mixing_plan(docs: DataFrame, weights: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per document: doc_id, source, block, slot, release, deadline, place.

    ``weights`` maps sources to whole numbers (1 for a source not named;
    together over ``MAX_PERIOD`` they are scaled down in proportion); by default
    they follow the square root of the source's size.  The mixture is
    the documents by (slot, place); every document comes once.  A source that
    runs out leaves its slots empty and the others keep their proportions.  A
    null source is a source of its own, named ''.  Rows that repeat a doc_id
    take places one after the other.
    """
    rows = docs.select("doc_id", "source", _null_hash(docs).alias("_none"), F.lit(0).alias("_tie"))
    return _scheduled(rows, weights, block_docs, "doc_id").withColumnRenamed("_s", "source")


def mixed(docs: DataFrame, weights: dict[str, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of ``docs`` in mixture order (files hold consecutive ranges of
    slots), with the columns of ``docs``; rows that repeat a doc_id come in the
    order of a hash of the whole row, nulls are as in ``mixing_plan``, an empty
    table gives none."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", _null_hash(docs).alias("_none"), row_hash(docs).alias("_tie"))
    out = _scheduled(rows, weights, block_docs, "row")
    return out.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place", "_s").select("row.*")


def written_order(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``position`` (0, 1, ... over all rows) of a frame read from
    the files of ``mixed``, in that order: a reader packs files by size, so the
    order comes from the number of the file and the row's place in it."""
    meta = docs.metadataColumn("_metadata")
    part = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1).cast("bigint")
    rows = docs.select(*keep, part.alias("_part"), meta["file_name"].alias("_file"), meta["row_index"].alias("_row"))
    # One row per file.
    files = rows.groupBy("_part", "_file").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("_part", "_file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    out = rows.join(F.broadcast(files), "_file").select(*keep, (F.col("_before") + F.col("_row")).alias("position"))
    return out.repartitionByRange("position").sortWithinPartitions("position")
