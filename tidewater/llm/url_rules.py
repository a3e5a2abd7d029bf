"""URL rules by a Bloom filter cascade.

A rule covers a host with its subdomains and the paths that begin with the
rule's path.  Every url yields candidate keys: the suffixes of its host and the
leading parts of its path that are as deep as some listed rule (deeper ones
cannot be listed).  The distinct candidates of the corpus are the complete
universe of keys that will ever be asked for.  Level 1 of the cascade
encodes the listed keys; keys of the universe that it passes wrongly are
encoded by level 2, listed keys that level 2 passes wrongly by level 3, and so
on until a level has no false positive.  The first level a key fails tells,
exactly, whether it is listed, so urls are judged without a join.

Keys are hashed.  Where a listed key shares its hash with another candidate,
the cascade leaves that hash out and the listed texts decide.

Filters are built from keys hashed in Spark: a level is the set of bit places
its keys map to, aggregated distinctly.  A cascade over a rule list above
``SHARD_KEYS`` is made in shards of the key hash, and one shard at a time
travels to the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise

SHARD_KEYS = 4_000_000   # listed keys of one cascade: 10 MB of filter bits
BITS_PER_KEY = 10
PROBES = 4               # bit places of a key in a level

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
DEFAULT = "allow"        # of a url that no listed key covers

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, with A-Z in lower case;
    empty for null or no ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def depth_of(rule: Column) -> Column:
    """How many labels a rule's host and how many slashes its path has."""
    host = F.substring_index(rule, "/", 1)
    return F.struct(F.size(F.split(host, r"\.")).alias("labels"), (F.size(F.split(rule, "/")) - 1).alias("heads"))


def _with_candidates(rows: DataFrame, depths: list[tuple[int, int]]) -> DataFrame:
    """Add ``texts``: the keys a rule for a url can have, one for each depth
    (labels of the host from the right, slashes of the path from the left)
    that the url reaches."""
    rows = rows.withColumns({"labels": F.split("host", r"\."), "parts": F.split("path", "/")})
    shapes = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in depths]).cast("array<struct<a:int,b:int>>")
    fits = F.filter(shapes, lambda d: (F.size("labels") >= d["a"]) & (F.size("parts") > d["b"]))
    texts = F.transform(fits, lambda d: F.concat(F.array_join(F.slice("labels", F.size("labels") - d["a"] + 1, d["a"]), "."),
                                                 F.array_join(F.slice("parts", F.lit(1), d["b"]), "/"), F.lit("/")))
    return rows.withColumn("texts", texts).drop("labels", "parts")


@dataclass
class Level:
    """Bits of one Bloom filter and the seed of its places."""
    bits: np.ndarray
    size: int
    seed: int

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = places(keys, self.seed, self.size)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def places(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
    """PROBES bit places of each 64-bit key: double hashing over two mixes."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        step = (x >> np.uint64(32)) | np.uint64(1)
        return ((x[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(size)).astype(np.int64)


def listed(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """Whether each key is listed; exact for keys of the universe."""
    out, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
    for depth, level in enumerate(levels):
        has = level.has(keys[open_])
        out[open_[~has]] = depth % 2 == 1  # failing an odd level: not listed; an even one: listed
        open_ = open_[has]
    out[open_] = len(levels) % 2 == 1
    return out


def _level(keys: DataFrame, count: int, seed: int) -> Level:
    """A filter over ``keys`` (column key): tasks send the bit places set, each once."""
    size = max(64, count * BITS_PER_KEY)

    def set_places(batches):
        for batch in batches:
            at = np.unique(places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), seed, size))
            byte, first = np.unique(at >> 3, return_index=True)
            value = np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), first) if len(at) else np.zeros(0, np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(byte), pa.array(value.astype(np.int32))], ["byte", "value"])

    bits = np.zeros((size + 7) // 8, np.uint8)
    # A shard's filter: SHARD_KEYS * BITS_PER_KEY / 8 bytes at most.
    rows = keys.select("key").mapInArrow(set_places, "byte bigint, value int").groupBy("byte").agg(F.bit_or("value").alias("value")).toArrow()
    bits[rows.column("byte").to_numpy()] = rows.column("value").to_numpy().astype(np.uint8)
    return Level(bits, size, seed)


def build_cascade(universe: DataFrame, member: DataFrame) -> list[Level]:
    """Levels over distinct keys: ``member`` (listed) and ``universe`` (both
    with a bigint column key).  Ends with the first level without a false
    positive; every level's candidates are what the level before passed."""
    inside, outside, levels = member, universe.join(member, "key", "left_anti"), []
    while True:
        encoded, other = (inside, outside) if len(levels) % 2 == 0 else (outside, inside)
        count = encoded.count()
        if not count:
            return levels
        level = _level(encoded, count, len(levels) + 1)
        levels.append(level)

        def passing(batches, level=level):
            for batch in batches:
                keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[level.has(keys)].view(np.int64))], ["key"])

        wrong = materialise(other.mapInArrow(passing, "key bigint"), "cascade-level")
        inside, outside = (inside, wrong) if len(levels) % 2 == 1 else (wrong, outside)


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has columns rule (host, then a path that ends in /) and verdict
    (block or allow); the longest rule that fits decides, else ``default``.
    The verdict of a listed key comes from a second cascade over listed keys,
    with those that block as its members.  Null urls and urls without :// have
    empty host and path and no rule.  Repeated pages are judged one by one.
    """
    if not rules.where(~F.col("rule").endswith("/")).isEmpty():
        raise ValueError("a rule's path ends in /")
    # Depths are pairs of small numbers, however many rules have them.
    depths = sorted(tuple(r) for r in rules.select(depth_of(F.col("rule")).alias("d")).distinct().select("d.labels", "d.heads").collect())
    rows = _with_candidates(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), depths)
    universe = materialise(rows.select(F.explode("texts").alias("text")).distinct().select(_key(F.col("text")).alias("key"), "text"), "url-keys")
    wanted = rules.groupBy(F.col("rule").alias("text")).agg(F.max("verdict").alias("verdict"))
    hit = materialise(universe.join(wanted, "text"), "url-listed")
    twice = universe.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    clash = materialise(hit.join(twice, "key", "left_semi"), "url-clashes")
    shards = max(1, -(-hit.count() // SHARD_KEYS))
    out = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    for shard in range(shards):
        mine = F.pmod(F.xxhash64("key"), F.lit(shards)) == shard
        texts = clash.where(mine)
        keys, member = (x.where(mine).join(texts.select("key").distinct(), "key", "left_anti") for x in (universe, hit))
        cascade = build_cascade(keys.select("key").distinct(), member.select("key"))
        blocks = build_cascade(member.select("key"), member.where("verdict = 'block'").select("key"))
        out = _apply(out, cascade, blocks, texts)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _apply(rows: DataFrame, cascade: list[Level], blocks: list[Level], texts: DataFrame) -> DataFrame:
    """The longest listed candidate of each row, if longer than its rule so
    far; ``texts`` (key, text, verdict) are listed keys whose hash is shared."""
    # plain values: a broadcast is unpickled by executors without this package
    levels = rows.sparkSession.sparkContext.broadcast([[(x.bits, x.size, x.seed) for x in c] for c in (cascade, blocks)])
    # Listed keys of one shard at most, and hardly ever any.
    exact = rows.sparkSession.sparkContext.broadcast([(r.key, r.text, r.verdict) for r in texts.collect()])
    with_keys = rows.withColumn("keys", F.transform("texts", _key))
    held = [f for f in rows.schema if f.name != "texts"]

    def run(batches):
        inside, blocking = ([Level(*x) for x in c] for c in levels.value)
        shared = np.array(sorted({k for k, _, _ in exact.value}), np.int64).view(np.uint64)
        by_text = {text: verdict for _, text, verdict in exact.value}
        for batch in batches:
            lists = batch.column("keys")
            keys = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            unclear = np.isin(keys, shared)
            found = np.flatnonzero(listed(inside, keys) & ~unclear) if inside else np.zeros(0, np.int64)
            texts = batch.column("texts").flatten()
            rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            block = listed(blocking, keys[found]) if blocking else np.zeros(len(found), bool)
            fits = [(k, texts[k].as_py(), "block" if b else "allow") for k, b in zip(found.tolist(), block.tolist(), strict=True)]
            fits += [(k, text, by_text[text]) for k in np.flatnonzero(unclear).tolist() if (text := texts[k].as_py()) in by_text]
            for k, text, answer in fits:
                row = owner[k]
                if rule[row] is None or (len(text), text) > (len(rule[row]), rule[row]):
                    rule[row], verdict[row] = text, answer
            done = {"rule": pa.array(rule, pa.string()), "verdict": pa.array(verdict, pa.string())}
            yield pa.RecordBatch.from_arrays([done[n] if n in done else batch.column(n) for n in names], names)

    names = [f.name for f in held] + ["texts"]
    return with_keys.mapInArrow(run, rows.select(*names).schema)
