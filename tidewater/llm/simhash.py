"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is a ring of four 16-bit segments.  Two fingerprints at
most three bits apart have a segment from which every chain of consecutive
segments stays within its share of the budget: no difference in the first, one
bit at most in the first two, two at most in the first three.  The first two
links of that chain give a 32-bit key: each distinct fingerprint is stored
under its own pairs of neighbouring segments and looks up those that differ by
at most one bit in the second.  What meets under a key goes through the third
link and then the full Hamming check.

The stored fingerprints of a key and its lookups are cut into blocks, each
side by its own number, and each pair of blocks is compared apart, a bounded
number of pairs at once; a pair of blocks returns a spanning forest of its
links, so the output grows with the fingerprints and not with their pairs.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, row_hash, whole_text
from .components import smallest_reachable

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS, SEGMENT_BITS = 4, 16   # MAX_BITS 3 over 4 segments: budgets 0, 1, 2, 3
SEED = 42
BLOCK = 1024                     # fingerprints of one key that one task compares at once
SLICE = 1 << 17                  # shingles whose bits are counted at once, about
PIECE = 1 << 19                  # bytes of a text that are split into words at once
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def _words(text: str):
    """Lists of consecutive words, each of about ``PIECE`` bytes of the text."""
    data, at = text.encode("utf-8").lower(), 0  # bytes: A-Z and the six white space characters alone
    while at < len(data):
        cut = _BREAK.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def _shingle_hashes(text: str, k: int):
    """Lists of the hashes of a text's shingles, piece by piece."""
    digest, tail, full = xxhash.xxh64_intdigest, [], False
    for words in _words(text):
        words = tail + words
        if len(words) >= k:
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            joined, starts = b" ".join(words), (ends - sizes).tolist()
            yield [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())]
            full = True
        tail = words[len(words) - k + 1:] if len(words) >= k else words
    if tail and not full:
        yield [digest(b" ".join(tail), SEED)]


def fingerprint_batch(texts: list[str | None], words_per_shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned fingerprints of texts; a text without words has zero.  Bits are
    counted over slices of shingles, so a long text needs little memory."""
    set_, sizes = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    hashes, owner, count = [], [], []

    def add_up():
        if hashes:
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            np.add.at(set_, owner, np.add.reduceat(bits, np.r_[0, np.cumsum(count)[:-1]], axis=0, dtype=np.int64))
            np.add.at(sizes, owner, count)
        for rows in (hashes, owner, count):
            rows.clear()

    for i, text in enumerate(texts):
        for some in _shingle_hashes(text or "", words_per_shingle):
            hashes += some
            owner.append(i)
            count.append(len(some))
            if len(hashes) >= SLICE:
                add_up()
    add_up()
    more = (2 * set_ > sizes[:, None]).astype(np.uint8)
    return np.packbits(more, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, *keep: str) -> DataFrame:
    """doc_id, fingerprint (as a signed long) and the string columns ``keep`` of
    every row; null text counts as empty."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                prints = fingerprint_batch(texts[a:b], words_per_shingle).view(np.int64)
                kept = [c.slice(a, b - a) for c in batch.columns[2:]]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(prints), *kept], ["doc_id", "fp", *keep])
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"], *keep)
    return rows.mapInArrow(run, ", ".join(["doc_id bigint, fp bigint", *[f"{c} string" for c in keep]]))


def _segment(fp, i: int):
    return F.shiftrightunsigned(fp, SEGMENT_BITS * (i % SEGMENTS)).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _keys(fp, flip: bool):
    """Two-segment keys of a fingerprint, with the start segment in the top
    bits; ``flip``: also those with one bit of the second segment changed."""
    out = []
    for i in range(SEGMENTS):
        base = F.shiftleft(_segment(fp, i), SEGMENT_BITS) + _segment(fp, i + 1) + F.lit(i << 2 * SEGMENT_BITS)
        out += [base.bitwiseXOR(F.lit(1 << bit)) for bit in range(SEGMENT_BITS)] if flip else []
        out.append(base)
    return F.explode(F.array(*out))


def _within_budget(key: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Pigeonring's third link and the full check, for differences ``x``."""
    start = (key >> (2 * SEGMENT_BITS)).astype(np.uint64)
    turn = start * np.uint64(SEGMENT_BITS)
    ring = (x >> turn) | (x << ((np.uint64(64) - turn) % np.uint64(64)))
    three = np.uint64((1 << 3 * SEGMENT_BITS) - 1)
    viable = np.bitwise_count(ring & three) <= 3 * MAX_BITS // SEGMENTS
    return viable & (np.bitwise_count(x) <= MAX_BITS) & (x != 0)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) over the given links."""
    nodes, ends = np.unique(np.r_[a, b], return_inverse=True)
    a, b, label = ends[:len(a)], ends[len(a):], np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            moved = label != np.arange(len(nodes))
            return nodes[moved], nodes[label[moved]]


def _compare(batches):
    """Links among rows that share (key, own block, other block); rows come
    sorted by those, the stored fingerprints (probe 0) before the lookups."""
    def links(rows):
        key, probe, fp = rows["key"], rows["probe"], rows["fp"]
        first = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(rows["own"]) != 0) | (np.diff(rows["other"]) != 0)])
        last = np.r_[first[1:], len(key)]
        stored = np.add.reduceat((probe == 0).astype(np.int64), first)
        looks = last - first - stored
        some = np.flatnonzero((stored > 0) & (looks > 0))
        # A group's lookups come in slices of at most ``most`` pairs (one lookup at least).
        most = 4 * BLOCK * BLOCK
        step = np.maximum(1, most // stored[some])
        slices = -(-looks[some] // step)
        group, nth = np.repeat(some, slices), _counting(slices)
        step = np.repeat(step, slices)
        begin = first[group] + stored[group] + nth * step
        count = np.minimum(step, looks[group] - nth * step)
        pairs = np.cumsum(stored[group] * count)
        a = b = np.zeros(0, np.int64)
        at = done = 0
        while at < len(group):
            upto = at + max(1, int(np.searchsorted(pairs[at:], done + most, side="right")))
            g, n = group[at:upto], count[at:upto]
            look = np.repeat(begin[at:upto], n) + _counting(n)
            size = np.repeat(stored[g], n)
            left = np.repeat(look, size)
            right = np.repeat(np.repeat(first[g], n), size) + _counting(size)
            ok = _within_budget(key[left], (fp[left] ^ fp[right]).view(np.uint64))
            a, b = np.r_[a, fp[left[ok]]], np.r_[b, fp[right[ok]]]
            if len(a) > BLOCK * BLOCK:
                a, b = _forest(a, b)
            at, done = upto, pairs[upto - 1]
        if len(a):
            a, b = _forest(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    rest = None
    for batch in batches:
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "own", "other", "probe", "fp")}
        if rest is not None:
            rows = {n: np.concatenate([rest[n], rows[n]]) for n in rows}
        # The last group may go on in the next batch.
        tail = tuple(rows[n][-1] for n in ("key", "own", "other"))
        cut = np.flatnonzero((rows["key"] != tail[0]) | (rows["own"] != tail[1]) | (rows["other"] != tail[2]))
        cut = cut[-1] + 1 if len(cut) else 0
        if cut:
            yield from links({n: v[:cut] for n, v in rows.items()})
        rest = {n: v[cut:] for n, v in rows.items()}
    if rest is not None and len(rest["key"]):
        yield from links(rest)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... size - 1 for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _dealt(prints: DataFrame, block: int) -> DataFrame:
    """key, own (block of stored fingerprints), other (block of lookups),
    probe (0 stored, 1 lookup), fp."""
    stored = prints.select("fp", _keys(F.col("fp"), False).alias("key"))
    looks = prints.select("fp", _keys(F.col("fp"), True).alias("key"))
    sizes = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # A key's lookups are what is stored under it and the keys one bit away in
    # the second segment.  Those with few each add less than one block in all.
    around = F.explode(F.array(F.col("key"), *[F.col("key").bitwiseXOR(F.lit(1 << bit)) for bit in range(SEGMENT_BITS)]))
    warm = materialise(sizes.where(F.col("n") * (SEGMENT_BITS + 1) > block), "simhash-warm")
    looked = warm.select(around.alias("key"), "n").groupBy("key").agg(F.sum("n").alias("m"))
    blocks = lambda c: F.ceil(F.col(c) / block).cast("int")
    many = materialise(looked.where(F.col("m") > block).join(sizes, "key", "left")
                       .select("key", F.coalesce(blocks("n"), F.lit(1)).alias("owns"), blocks("m").alias("others")), "simhash-many")

    def dealt(rows, probe: int):
        mine, every = ("others", "owns") if probe else ("owns", "others")
        rows = rows.join(many, "key", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("owns", "others")})
        mine = F.pmod(F.xxhash64("fp"), F.col(mine)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(every) - 1))
        own, other = (every, mine) if probe else (mine, every)
        return rows.withColumn("own", own).withColumn("other", other).select("key", "own", "other", F.lit(probe).alias("probe"), "fp")

    if many.isEmpty():
        plain = lambda rows, probe: rows.select("key", F.lit(0).alias("own"), F.lit(0).alias("other"), F.lit(probe).alias("probe"), "fp")
        return plain(stored, 0).union(plain(looks, 1))
    return dealt(stored, 0).union(dealt(looks, 1))


def near_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links a, b that connect all fingerprints (column fp, distinct) at most
    MAX_BITS apart: every two such fingerprints are joined by a path."""
    return (_dealt(prints, block).repartition("key", "own", "other").sortWithinPartitions("key", "own", "other", "probe")
            .mapInArrow(_compare, "a bigint, b bigint"))


def _groups(rows: DataFrame) -> DataFrame:
    """fp, root (a fingerprint of the component, the same for all of its
    members) and component_id for the distinct fingerprints of ``rows`` (doc_id, fp)."""
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = smallest_reachable(near_links(nodes.select("fp")))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_groups(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and link like any other.
    component_id is the smallest doc_id in the component; null ids count only
    where there is no other.  Repeated rows share a component; other columns
    are ignored; an empty table gives none.
    """
    rows = materialise(fingerprints(docs, words_per_shingle), "simhash-rows")
    return (rows.join(_groups(rows), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the one with the
    smallest doc_id, null ids last; of rows that repeat it the one with the
    smallest fingerprint, then the smallest hash of id and text, then of the
    whole row.  An empty table gives none."""
    packed = docs.select(F.struct("*").alias("row"), row_hash(docs).alias("_tie"), F.col("doc_id"), F.col("text"))
    held = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), whole_text())
    packed = packed.withColumn("_mark", F.sha2(F.encode(held, "UTF-8"), 256))
    rows = materialise(fingerprints(packed, words_per_shingle, "_mark"), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "_mark")
    # Copies of a row collapse first, so a large component leaves few rows.
    first = (rows.distinct().join(_groups(rows), "fp").groupBy("root").agg(F.min(order).alias("first"))
             .select(F.col("first._mark").alias("_mark")))
    return (packed.select("row", "_tie", "_mark").join(first, "_mark", "left_semi")
            .groupBy("_mark").agg(F.min_by("row", "_tie").alias("row")).select("row.*"))
