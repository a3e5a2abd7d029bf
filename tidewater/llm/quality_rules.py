"""Quality rules and a hashed n-gram likelihood ratio, on DataFrame functions.

Word uni- and bigrams hash into ``BUCKETS`` features.  Their log-likelihood
ratio between a trusted target (documents labelled good) and the raw corpus,
divided by the number of n-grams, rates every document; a threshold that
follows from the ratings of all labelled documents decides.  The raw counts
cover the texts of all documents, each distinct text once, so copies do not
move them; the target is a bounded sample of labelled rows.  What travels to
every task is one ratio per bucket, so its size depends on ``BUCKETS`` alone.

A document is rated inside its own row with array functions: no document is
exploded into a shuffle, and no join brings its parts together again.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, whole_text

BUCKETS = 8192            # hashed n-gram features, a power of two
TRUSTED_ROWS = 20_000     # labelled rows the target is fitted on, at most
THRESHOLD = -0.4          # smallest mean log ratio that is kept where labels give no threshold
GOOD_LOST = 1000          # one of so many distinct texts labelled good may be rejected, at most
STEPS = 1000              # steps of the labelled ratings' histogram in one unit of the ratio
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5

_WORD_BREAK = r"[\x20\x09-\x0D]+"
_NOT_SYMBOL = r"[^#*$%&|<>]+"


def _at(array: str, place: Column) -> Column:
    return F.get(F.col(array), place)


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _held(column: Column) -> Column:
    """The column, not deterministic to the optimizer: a filter on it stays
    above its projection.  Pushed below, the filter would take the array
    columns' definitions into lambda functions and evaluate them per element."""
    return F.when(F.spark_partition_id() >= 0, column)


def with_grams(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep``, text, hashes (one per word) and pairs (one per word:
    with the next word, for the last word with none)."""
    return (docs.select(*keep, whole_text().alias("text"))
            .withColumn("words", F.array_remove(F.split("text", _WORD_BREAK), ""))
            .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("pairs", F.transform("hashes", lambda h, i: F.xxhash64(h, _at("hashes", i + 1)))))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[float]:
    """The log ratio of each bucket, add-one smoothed, rounded to 6 decimals.
    Equal texts count once, as trusted if one of them is.

    ``trusted_ids`` (doc_id) has ``TRUSTED_ROWS`` rows at most.  Without any
    trusted document all ratios are 0.
    """
    marks = F.broadcast(trusted_ids.select("doc_id", F.lit(1).alias("trusted")))
    texts = docs.select("doc_id", "text").join(marks, "doc_id", "left").groupBy("text").agg(F.max("trusted").alias("trusted"))
    grams = with_grams(texts, "trusted")
    counts = (grams.select("trusted", F.explode(F.concat("hashes", "pairs")).alias("gram"))
              .groupBy(_bucket(F.col("gram")).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("target"))
              .collect())  # one row per bucket: BUCKETS rows at most
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for bucket, n_raw, n_target in counts:
        raw[bucket] += n_raw
        target[bucket] += n_target
    scale, any_target = log(sum(raw) / sum(target)), sum(target) > BUCKETS
    return [round(log(t / r) + scale, 6) if any_target else 0.0 for t, r in zip(target, raw)]


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """doc_id of documents labelled good: all, or the ``rows`` with the
    smallest id hashes."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at the ascending ``starts``."""
    first = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, s: F.struct(s.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), s - acc["at"])).alias("n"))
    return F.aggregate(starts, first, step, lambda acc: acc["n"])


def rate(docs: DataFrame, ratios: list[float], *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` and n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, llr, kept; one row per row of ``docs``.

    Null and empty texts have no words, so base_failed is true; their llr is 0.
    """
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast(T.ArrayType(T.DoubleType()))
    n = F.size("hashes")
    lines = F.filter(F.split("text", "\n"), lambda s: F.rlike(s, F.lit(r"[^\x20\x09-\x0D]")))
    # Words i to i+4 are the pairs at i and i+2 and the word at i+4.
    windows = F.transform(F.slice("pairs", F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0))),
                          lambda p, i: F.xxhash64(p, _at("pairs", i + 2), _at("hashes", i + 4)))
    base = (with_grams(docs, *keep)
            .select(*keep, "hashes", "pairs", windows.alias("windows"), lines.alias("lines"), n.cast("bigint").alias("n_words"),
                    F.length(F.regexp_replace("text", _WORD_BREAK, "")).cast("bigint").alias("word_chars"),
                    F.length(F.regexp_replace("text", _NOT_SYMBOL, "")).cast("bigint").alias("n_symbols")))
    # Sort the windows only of texts that repeat one.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    none = F.array().cast("array<struct<w:bigint,i:int>>")
    base = base.select(
        *keep, "hashes", "pairs", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(repeats, placed).otherwise(none).alias("placed"))
    same = lambda e, at: e["w"].eqNullSafe(_at("placed", at)["w"])
    twice = F.filter("placed", lambda e, i: same(e, i - 1) | same(e, i + 1))
    starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
    summed = lambda grams: F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, _bucket(g)))
    total = summed("hashes") + summed("pairs")
    grams = F.greatest(2 * F.col("n_words"), F.lit(1))
    out = base.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      _held(_covered(starts)).alias("n_repeat_words"), _held(F.round(total / grams, 6)).alias("llr"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)))


def separating(steps: list[tuple[int, int, int]]) -> float:
    """The threshold from (quality, step, texts): of those that reject one in
    ``GOOD_LOST`` good texts at most the highest, lowered halfway to the next
    bad text below it.  ``THRESHOLD`` if either label has no text."""
    good = sorted((step, n) for quality, step, n in steps if quality == 1)
    bad = [step for quality, step, _ in steps if quality == 0]
    if not good or not bad:
        return THRESHOLD
    spare = sum(n for _, n in good) // GOOD_LOST
    for lowest, n in good:
        spare -= n
        if spare < 0:
            break
    below = max((step + 1 for step in bad if step < lowest), default=lowest)
    return (below + lowest) / 2 / STEPS


def labelled_threshold(rated: DataFrame, labels: DataFrame) -> float:
    """The threshold from all labelled documents that pass the base rules, each
    distinct text once; ``rated`` has doc_id, sha, base_failed and llr."""
    marks = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    texts = rated.where(~F.col("base_failed")).join(marks, "doc_id").select("quality", "sha", "llr").distinct()
    steps = texts.groupBy("quality", F.floor(F.col("llr") * STEPS).alias("step")).count()
    return separating([tuple(r) for r in steps.collect()])  # one row per label and step


def _rated(docs: DataFrame, ratios: list[float]) -> DataFrame:
    rows = docs.select("doc_id", "text", F.sha2(F.encode(whole_text(), "UTF-8"), 256).alias("sha"))
    return materialise(rate(rows, ratios, "doc_id", "sha").drop("kept"), "quality-rated")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """doc_id and the columns of ``rate`` for every document.  A doc_id that is
    repeated or null is rated row by row; other columns are ignored.  Without a
    ``threshold`` the labelled documents give it."""
    rated = _rated(docs, log_ratios(docs, trusted_sample(labels)))
    threshold = labelled_threshold(rated, labels) if threshold is None else threshold
    return rated.drop("sha").withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``.
    Every row is rated by itself, repeated ones and those without id included;
    null and empty texts go (no words), and an empty table gives none.  Rows
    are rated once and written with their rating."""
    sha = F.sha2(F.encode(whole_text(), "UTF-8"), 256)
    rows = docs.select(F.struct("*").alias("row"), "text", sha.alias("sha"))
    ratios = log_ratios(docs, trusted_sample(labels))
    rated = materialise(rate(rows, ratios, "row", "sha").select("row", "sha", "base_failed", "llr"), "quality-rated")
    if threshold is None:
        threshold = labelled_threshold(rated.select("row.doc_id", "sha", "base_failed", "llr"), labels)
    return rated.where(~F.col("base_failed") & (F.col("llr") >= threshold)).select("row.*")
