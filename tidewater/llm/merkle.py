"""A hash tree over a table: leaves, proofs and their check as Spark jobs.

Nodes of one tree are numbered 0, 1, 2, ...; eight consecutive ones make a
node of the next level until a single one remains.  ``SPAN`` = 8 ** ``DEPTH``
consecutive nodes form a superblock, whose work is one bounded group: a tree
is reduced superblock by superblock, the superblocks' roots are the nodes of
the next layer, and so on.  Back down, each superblock is cogrouped with the
outer nodes it needs (the path of its root): in that one step a task reduces
the superblock again, joins local and outer siblings to proofs, and folds the
leaves up to the root.

Numbering uses range partitions written as one file each: a row's number is
its place in its file plus the sizes of the files before, per tree.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise

FANOUT = 8
DEPTH = 4
SPAN = FANOUT ** DEPTH

PATH = "array<struct<place: int, siblings: array<string>>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A field's text: its length in bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def tree_of(key: Column) -> Column:
    """A key's tree name: null before all others, then bytewise."""
    return F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), key.cast("string")))


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Adds ``idx`` (0, 1, ... within ``tree`` in the given order) and ``n``,
    the tree's number of rows.  Equal rows are numbered in any order."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    keys = ["tree", *order]
    # A last, unique key lets equal rows fall into several slices.
    sliced = (rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*keys, "row")
              .sortWithinPartitions(*keys).drop("row").withColumn("slice", F.spark_partition_id()))
    sliced.write.option("maxRecordsPerFile", 0).parquet(path)
    placed = spark.read.schema(sliced.schema).parquet(path).withColumn("at", F.col("_metadata.row_index"))
    spans = placed.groupBy("tree", "slice").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("tree", "slice", (before - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n"))
    return materialise(placed.join(spans, ["tree", "slice"]).withColumn("idx", F.col("at") + F.col("shift")).drop("slice", "at", "shift"), name)


def climb(nodes: list[str], steps: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up, ``steps`` of them above."""
    levels = [nodes]
    for _ in range(steps):
        last = levels[-1]
        levels.append([digest("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return levels


def height(n: int) -> int:
    """Levels above ``n`` nodes of a whole tree, at most those of a superblock."""
    steps = 0
    while n > 1 and steps < DEPTH:
        n, steps = -(-n // FANOUT), steps + 1
    return steps


def local_path(levels: list[list[str]], place: int) -> list[tuple[int, list[str]]]:
    """(place within the run, siblings) at each level, from a node of the
    superblock up to its root."""
    out = []
    for level in levels[:-1]:
        start = place // FANOUT * FANOUT
        run = level[start:start + FANOUT]
        out.append((place - start, run[:place - start] + run[place - start + 1:]))
        place //= FANOUT
    return out


def fold(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a node and its siblings lead to."""
    for place, siblings in path:
        node = digest("".join([*siblings[:place], node, *siblings[place:]]))
    return node


def _superblock(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("sb", F.expr(f"idx div {SPAN}"))


def reduced(nodes: DataFrame) -> DataFrame:
    """The next layer: one node (tree, idx, node, n) per superblock."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        first, n = group.iloc[0], int(group["n"].iloc[0])
        levels = climb(group.sort_values("idx")["node"].tolist(), height(n))
        return pd.DataFrame({"tree": [first["tree"]], "idx": [int(first["sb"])], "node": [levels[-1][0]], "n": [-(-n // SPAN)]})
    return (_superblock(nodes.select("tree", "idx", "node", "n")).groupBy("tree", "sb")
            .applyInPandas(run, "tree string, idx bigint, node string, n bigint"))


def layers(nodes: DataFrame) -> list[DataFrame]:
    """The nodes and at least one layer above them, up to one node a tree."""
    out = [nodes, materialise(reduced(nodes), "tree_layer")]
    longest = nodes.agg(F.max("n")).first()[0] or 0
    while longest > SPAN:
        out.append(materialise(reduced(out[-1]), "tree_layer"))
        longest = -(-longest // SPAN)
    return out


def _outer(row) -> list[tuple[int, list[str]]]:
    return [(int(p["place"]), list(p["siblings"])) for p in row["path"]]


def paths(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Of every node its path to the root, from the paths (``outer``: tree,
    idx, path, subroot, root) of the superblocks' roots."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ("tree", "idx", "path", "subroot", "root")})
        left, up = left.sort_values("idx"), right.iloc[0]
        levels = climb(left["node"].tolist(), height(int(left["n"].iloc[0])))
        rest = _outer(up)
        found = [[{"place": p, "siblings": s} for p, s in local_path(levels, i) + rest] for i in range(len(left))]
        return pd.DataFrame({"tree": left["tree"].tolist(), "idx": left["idx"].tolist(), "path": found, "subroot": up["subroot"], "root": up["root"]})
    return (_superblock(nodes.select("tree", "idx", "node", "n")).groupBy("tree", "sb")
            .cogroup(outer.groupBy("tree", "idx")).applyInPandas(run, f"tree string, idx bigint, path {PATH}, subroot string, root string"))


def down(tree_layers: list[DataFrame], top: DataFrame, name: str) -> DataFrame:
    """Paths of the second-lowest layer's nodes (what the lowest superblocks
    need), handed down from the paths of the single nodes on top."""
    for layer in reversed(tree_layers[1:-1]):
        top = materialise(paths(layer, top), name)
    return top


def checked(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    """Reduction, proof and folding of the leaves (tree, idx, n, doc_id, node,
    changed) in one cogrouped step a superblock."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")})
        left, up = left.sort_values("idx"), right.iloc[0]
        levels = climb(left["node"].tolist(), height(int(left["n"].iloc[0])))
        rest = _outer(up)
        beyond = "".join("".join(s) for _, s in rest)
        proof, folded = [], []
        for i, changed in enumerate(left["changed"]):
            path = local_path(levels, i)
            proof.append(digest("".join("".join(s) for _, s in path) + beyond))
            folded.append(fold(changed, path + rest))
        return pd.DataFrame({"doc_id": left["doc_id"].astype("Int64"), "leaf": left["node"], "subroot": up["subroot"], "root": up["root"],
                             "proof_sha256": proof, "folded_root": folded})
    return (_superblock(leaves).groupBy("tree", "sb").cogroup(outer.groupBy("tree", "idx"))
            .applyInPandas(run, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string"))


def tampered(doc_id: Column) -> Column:
    """True where 3 divides the crc32 of the id's decimal text; null ids: false."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    A leaf hashes the columns doc_id, source, lang, n_chars and text (null:
    ``-``, so null and empty differ).  Within a language leaves stand by
    doc_id, null ids first; rows with one id stand by leaf, and equal rows are
    interchangeable.  Documents without a language have a tree of their own.
    A single document is its own subroot and root, with no siblings.  Every
    third document (``tampered``) is folded from a leaf of its lower-cased
    text.  An empty table gives no rows; other columns are ignored.
    """
    col = {c: docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")}
    lower = F.translate(col["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = leaf_of(*col.values())
    changed = F.when(tampered(col["doc_id"]) & (lower != col["text"]), leaf_of(*(col | {"text": lower}).values())).otherwise(leaf)
    rows = docs.select(col["doc_id"].cast("bigint").alias("doc_id"), tree_of(col["lang"]).alias("tree"), leaf.alias("node"), changed.alias("changed"))
    # Written first: texts are hashed once, not again for the range bounds.
    leaves = numbered(materialise(rows, "leaf_rows"), ["doc_id", "node"], "leaves")
    low = layers(leaves)
    # The trees' roots are the nodes of one more tree.
    subroots = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("part"), "node")
    top = layers(numbered(subroots, ["part"], "subroots"))
    none = F.array().cast(PATH)
    root = top[-1].select("tree", "idx", none.alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    found = paths(top[0], down(top, root, "top_paths"))
    mine = top[0].join(found.select("idx", "path", "root"), "idx")
    outer = mine.select(F.col("part").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "path", F.col("node").alias("subroot"), "root")
    outer = materialise(outer, "tree_tops")
    return checked(leaves, down(low, outer, "tree_paths")).withColumn("verified", F.col("folded_root") == F.col("root"))
