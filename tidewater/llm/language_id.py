"""Language identification with interpolated Kneser-Ney character models.

Training counts the character 4-grams of words, padded at both ends, over all
documents: tasks send counts per (language, 4-gram), Spark adds them up.  Four
characters of 16 bits pack into one 64-bit key, and a key's lower orders are
its trailing characters.  Continuation counts, totals, back-off weights and
probabilities are joins and aggregates over all grams, with no cut.

Scoring needs one number per language for every 4-gram that occurs anywhere in
the corpus: its log probability, backed off as far as needed.  These rows are
worked out by joins too, order by order, and travel to the tasks as sorted key
arrays, ``SHARD_BYTES`` at a time: a text's score is a sum over its characters,
so each shard adds its part.

The language with the lowest cross-entropy per character is predicted.  Per
language the cross-entropies of all its training documents give the limit
beyond which a text is rejected (its own column); the sharpness of the score
comes from the log loss over all training documents.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, held_out, materialise

ORDER = 4
MAX_LANGUAGES = 10_000    # languages are categories; more of them is an input error
SHARD_BYTES = 64 << 20    # log probabilities that travel to the tasks at once
DISCOUNT = 0.75
UNKNOWN = "und"
MEMO_WORDS = 500_000
SHARPNESS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0)

_WORD = re.compile(r"[^\W\d_]+")
_OTHER = 0xFFFD           # unit of characters above 16 bits; 1 and 2 pad words


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case (numerals other than digits may be inside)."""
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def packed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram keys of every character of every word (and its end), with
    the place of the word."""
    padded = np.frombuffer("".join(f"\x01\x01\x01{w}\x02" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    unit = np.where(padded > 0xFFFF, _OTHER, padded).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    ends = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(unit)) - (ends - size)[owner] >= ORDER - 1
    at = np.flatnonzero(at)
    key = (unit[at - 3] << np.uint64(48)) | (unit[at - 2] << np.uint64(32)) | (unit[at - 1] << np.uint64(16)) | unit[at]
    return key, owner[at]


def _training() -> Column:
    return F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id", 4, 2)


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, key, n over all documents; the grams of those that are not for
    training have a null lang."""
    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                for lang in sorted(set(langs[a:b]), key=lambda x: (x is not None, x or "")):
                    seen: Counter = Counter()
                    for k in range(a, b):
                        if langs[k] == lang:
                            seen.update(words_of(texts[k]))
                    if not seen:
                        continue
                    words = list(seen)
                    key, owner = packed(words)
                    times = np.fromiter(seen.values(), np.int64, len(words))[owner]
                    keys, where = np.unique(key, return_inverse=True)
                    n = np.bincount(where, weights=times).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "n"])
    rows = docs.where(F.col("text").isNotNull()).select(F.when(_training(), F.col("lang")).alias("lang"), "text")
    return rows.mapInArrow(run, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _lower(key: str, order: int) -> Column:
    """The trailing ``order`` characters of a key."""
    return F.col(key).bitwiseAND(F.lit((1 << 16 * order) - 1))


def _context(key: str) -> Column:
    return F.shiftrightunsigned(key, 16)


def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per order, lowest first: (lang, key, logp) of its grams and (lang, ctx,
    back) of its contexts, from the counts (lang, key, c) of the highest."""
    level, levels = counts.select("lang", "key", "c"), []
    for order in range(ORDER, 0, -1):
        levels.append(level)
        if order > 1:  # below the top a gram counts once per longer gram that ends in it
            level = materialise(level.groupBy("lang", _lower("key", order - 1).alias("key")).agg(F.count(F.lit(1)).cast("double").alias("c")), "kn_counts")
    out, below = [], None
    for order, level in enumerate(reversed(levels), 1):
        contexts = materialise(level.groupBy("lang", _context("key").alias("ctx")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
                               .withColumn("back", F.lit(DISCOUNT) * F.col("kinds") / F.col("total")), "kn_contexts")
        rows = level.withColumn("ctx", _context("key")).join(contexts, ["lang", "ctx"])
        if below is None:  # characters: one share is left for unknown ones
            rows = rows.withColumn("under", 1 / (F.col("kinds") + 1))
        else:
            lower = below.select("lang", F.col("key").alias("low"), F.col("p").alias("under"))
            rows = rows.withColumn("low", _lower("key", order - 1)).join(lower, ["lang", "low"])
        p = F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / F.col("total") + F.col("back") * F.col("under")
        below = materialise(rows.select("lang", "key", p.alias("p")), "kn_grams")
        out.append((below.select("lang", "key", F.log("p").alias("logp")), contexts.select("lang", "ctx", F.log("back").alias("back"), "kinds")))
    return out


def _by_language(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One map from language to value per key (a language comes once)."""
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("lang", value))).alias(name))


def resolved(universe: DataFrame, orders: list[tuple[DataFrame, DataFrame]], langs: list[str], floor: float) -> DataFrame:
    """key, logs: of every 4-gram of the universe its log probability in each
    language.  A gram that a language lacks takes the back-off weight of its
    context (if the language has that) and its lower order's value."""
    wanted = [universe.select("key").distinct()]
    for order in range(ORDER - 1, 0, -1):
        wanted.append(wanted[-1].select(_lower("key", order).alias("key")).distinct())
    below = None
    for order, (grams, contexts) in enumerate(orders, 1):
        rows = (wanted[ORDER - order].join(_by_language(grams, "key", "logp", "p"), "key", "left").withColumn("ctx", _context("key"))
                .join(_by_language(contexts, "ctx", "back", "b"), "ctx", "left"))
        if below is None:
            rows = rows.withColumn("under", F.array_repeat(F.lit(floor), len(langs)))
        else:
            rows = rows.withColumn("low", _lower("key", order - 1)).join(below.select(F.col("key").alias("low"), F.col("logs").alias("under")), "low")
        value = lambda lang, i: F.coalesce(F.try_element_at("p", lang), F.coalesce(F.try_element_at("b", lang), F.lit(0.0)) + F.get("under", i))
        below = materialise(rows.select("key", F.transform(F.array(*map(F.lit, langs)), value).alias("logs")), "kn_resolved")
    return below


@dataclass
class Model:
    """Sorted 4-gram keys and a log probability per key and language."""
    keys: np.ndarray
    logs: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Sum of the log probabilities of each word's grams, per language;
        grams that are not here (but in another shard) add nothing."""
        key, owner = packed(words)
        at, has = _find(self.keys, key)
        out = np.zeros((len(key), self.logs.shape[1]))
        out[has] = self.logs[at[has]]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        return np.add.reduceat(out, starts, axis=0)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Scorer:
    """Sums of log probabilities of texts, remembering words within a task."""

    def __init__(self, model: Model):
        self.model, self.place, self.scores = model, {}, np.zeros((0, model.logs.shape[1]))

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and language the sum over its characters, and the number
        of characters (each word's end counts as one; 0 without a letter)."""
        split = [words_of(t) for t in texts]
        new = list({w for ws in split for w in ws} - self.place.keys())
        if len(self.place) + len(new) > MEMO_WORDS:
            self.place, self.scores = {}, self.scores[:0]
            new = list({w for ws in split for w in ws})
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
        out, units = np.zeros((len(texts), self.scores.shape[1])), np.zeros(len(texts), np.int64)
        for i, ws in enumerate(split):
            if ws:
                at = np.fromiter(map(self.place.__getitem__, ws), np.int64, len(ws))
                out[i] = self.scores[at].sum(axis=0)
                units[i] = sum(map(len, ws)) + len(ws)
        return out, units


def _add_shard(rows: DataFrame, table: pa.Table, width: int) -> DataFrame:
    """``sums`` of every row plus what one shard's grams add to them."""
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    logs = np.array(table.column("logs").combine_chunks().flatten().to_numpy()).reshape(-1, width)[order]
    # plain values: a broadcast is unpickled by executors without this package
    shared = rows.sparkSession.sparkContext.broadcast((keys[order], logs))

    def run(batches):
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            texts, before = [t or "" for t in batch.column("text").to_pylist()], batch.column("sums")
            for a, b in chunks(texts):
                sums, units = scorer.sums(texts[a:b])
                if before.null_count < len(before):
                    sums = sums + before.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, width, dtype=np.int32), pa.array(sums.ravel()))
                done = {"sums": lists, "units": pa.array(units)}
                yield pa.RecordBatch.from_arrays([done[n] if n in done else batch.column(n).slice(a, b - a) for n in names], names)
    names = ["doc_id", "lang", "text", "sums", "units"]
    return rows.select(*names).mapInArrow(run, "doc_id bigint, lang string, text string, sums array<double>, units bigint")


def entropies(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """(doc_id, lang of training documents, entropies: nats per character in
    each language, null without a letter) of every document, and the languages."""
    known = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"], docs["lang"])
    rows = known.select("doc_id", F.when(_training(), F.col("lang")).alias("lang"), "text", F.lit(None).cast("array<double>").alias("sums"),
                        F.lit(0).cast("bigint").alias("units"))
    counts = materialise(gram_counts(known), "kn_grams")
    train = counts.where(F.col("lang").isNotNull()).select("lang", "key", F.col("n").cast("double").alias("c"))
    langs = sorted(r.lang for r in train.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not langs:
        return rows.select("doc_id", "lang", F.col("sums").alias("entropies")), langs
    orders = kneser_ney(train)
    units = orders[0][1].agg(F.max("kinds")).first()[0] + 1
    table = resolved(counts, orders, langs, -float(np.log(units)))
    shards = max(1, -(-table.count() * 8 * (1 + len(langs)) // SHARD_BYTES))
    for shard in range(shards):
        mine = table.where(F.pmod(F.xxhash64("key"), F.lit(shards)) == shard).toArrow()  # SHARD_BYTES, about
        rows = _add_shard(rows, mine, len(langs))
        if shard + 1 < shards:
            rows = materialise(rows, "kn_sums")
    per_unit = F.when(F.col("units") > 0, F.transform("sums", lambda x: -x / F.col("units")))
    return materialise(rows.select("doc_id", "lang", per_unit.alias("entropies")), "entropies"), langs


def calibration(scored: DataFrame, langs: list[str]) -> tuple[dict[str, float], float]:
    """From all training documents: per language the limit (mean and four
    deviations of the cross-entropy under the own language, or 1.2 times the
    largest), and the sharpness with the lowest log loss."""
    rows = scored.where(F.col("lang").isNotNull() & F.col("entropies").isNotNull())
    rows = rows.select("lang", "entropies", F.get("entropies", F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1).alias("own"))
    best = F.array_min("entropies")

    def loss(sharp: float) -> Column:
        total = F.aggregate("entropies", F.lit(0.0), lambda acc, e: acc + F.exp(-(e - best) * sharp))
        return F.sum((F.col("own") - best) * sharp + F.log(total))
    own = F.col("own")
    parts = rows.groupBy("lang").agg(F.greatest(F.avg(own) + 4 * F.stddev_pop(own), 1.2 * F.max(own)).alias("limit"),
                                     F.count(F.lit(1)).alias("n"), *[loss(s).alias(f"loss{i}") for i, s in enumerate(SHARPNESS)]).collect()  # one row a language
    n = sum(r.n for r in parts)
    losses = [round(sum(r[f"loss{i}"] for r in sorted(parts, key=lambda r: r.lang)) / n, 9) if n else 0.0 for i in range(len(SHARPNESS))]
    return {r.lang: r.limit for r in parts}, SHARPNESS[losses.index(min(losses))] if n else 10.0


def predict(langs: list[str], limits: dict[str, float], sharpness: float, entropies: list) -> tuple[list[str], list[float], list[bool]]:
    """Language, score, and whether the text is beyond its language's limit."""
    names, scores, beyond = [], [], []
    for row in entropies:
        if row is None:
            names.append(UNKNOWN)
            scores.append(0.0)
            beyond.append(True)
            continue
        e = np.asarray(row)
        best = int(e.argmin())
        names.append(langs[best])
        scores.append(round(float(1 / np.exp(-(e - e[best]) * sharpness).sum()), 6))
        beyond.append(bool(e[best] > limits.get(langs[best], np.inf)))
    return names, scores, beyond


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Trained on the documents that are not held out and have text and lang;
    without any, every prediction is und.  Null text or none with a letter:
    und, score 0, rejected.  Ties between languages go to the first by name.
    Repeated rows are predicted (and learnt from) one by one; other columns
    are ignored.
    """
    scored, langs = entropies(docs)
    limits, sharpness = calibration(scored, langs) if langs else ({}, 10.0)

    def run(batches):
        for batch in batches:
            names, scores, beyond = predict(langs, limits, sharpness, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(beyond, pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "rejected"])
    out = scored.select("doc_id", "entropies").mapInArrow(run, "doc_id bigint, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")
