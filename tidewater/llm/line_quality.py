"""Document quality from a CRF over lines.

Each line is a position of a linear chain with tags bad and good.  A line's
features come from its characters and from the lines before and after it.
Forward-backward marginals of good, weighted by line length, give a document's
share of good text; a logistic curve turns it into a score.

The chain is fitted on a bounded sample of labelled documents (``FIT_ROWS``);
every document is scored over all its lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, held_out
from .crf import fit as fit_chain
from .crf import marginals

FIT_ROWS = 2_000       # labelled documents the model is fitted on, at most
FIT_CHARS = 20_000_000  # their characters, at most
SLICE_LINES = 50_000   # lines whose features are held at once

# Character classes: 0 lower case, 1 upper case, 2 digit, 3 space, 4 symbol,
# 5 sentence mark, 6 exclamation or question mark, 7 bar, 8 other.
_CLASSES = 9


def _class_table() -> np.ndarray:
    out = np.full(0x110000, 8, np.uint8)
    for c in range(0x3000):
        ch = chr(c)
        out[c] = 0 if ch.islower() else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch in " \t\r\x0b\x0c" else out[c]
    for k, marks in ((4, "#*$%&<>@^~_=+/\\{}[]"), (5, ".,;:"), (6, "!?"), (7, "|")):
        for ch in marks:
            out[ord(ch)] = k
    return out


_TABLE: list[np.ndarray] = []


class Lines:
    """The lines of texts (an empty text has one empty line); features are made
    for any range of them."""

    def __init__(self, texts: list[str]):
        lines = [t.split("\n") for t in texts]
        self.sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        self.flat = [line for ls in lines for line in ls]
        self.length = np.fromiter(map(len, self.flat), np.int64, len(self.flat))
        self.repeat = np.zeros(len(self.flat))
        at = 0
        for ls in lines:
            seen = set()
            for line in ls:
                self.repeat[at] = line in seen
                seen.add(line)
                at += 1
        self.first = np.zeros(len(self.flat), bool)
        self.first[np.cumsum(self.sizes) - self.sizes] = True
        self.last = np.r_[self.first[1:], True]

    def _own(self, a: int, b: int) -> np.ndarray:
        """Features of lines a to b from the lines themselves."""
        if not _TABLE:
            _TABLE.append(_class_table())
        flat, length = self.flat[a:b], self.length[a:b]
        points = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(flat)), length)
        kind = _TABLE[0][points]
        count = np.bincount(owner * _CLASSES + kind, minlength=len(flat) * _CLASSES).reshape(-1, _CLASSES).astype(np.float64)
        word_start = (kind != 3) & np.r_[True, (kind[:-1] == 3) | (owner[:-1] != owner[1:])] if len(kind) else np.zeros(0, bool)
        words = np.bincount(owner[word_start], minlength=len(flat)).astype(np.float64)
        part = count / np.maximum(length, 1)[:, None]
        letters = np.maximum(count[:, 0] + count[:, 1], 1)
        split = map(str.split, flat)
        same = np.fromiter((1 - len(set(w)) / len(w) if w else 0 for w in split), np.float64, len(flat))
        return np.column_stack([
            part, count[:, 1] / letters, np.minimum(1, 4 * count[:, 4] / np.maximum(words, 1)), np.minimum(1, 2 * count[:, 6] / np.maximum(words, 1)),
            np.minimum(1, 2 * count[:, 7] / np.maximum(words, 1)), np.log1p(words) / 5, np.log1p(length) / 7,
            np.minimum(2, length / np.maximum(words, 1) / 10), self.repeat[a:b], same, length == 0])

    def features(self, a: int, b: int) -> np.ndarray:
        """Features of lines a to b, their neighbours' included."""
        lo, hi = max(a - 1, 0), min(b + 1, len(self.flat))
        near = np.pad(self._own(lo, hi), ((1 - (a - lo), 1 - (hi - b)), (0, 0)))
        own = near[1:-1]
        first, last = self.first[a:b], self.last[a:b]
        before = np.where(first[:, None], 0, near[:-2])
        after = np.where(last[:, None], 0, near[2:])
        return np.column_stack([np.ones(b - a), own, before, after, first, last])


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, the lines' lengths, and the number
    of lines of each text."""
    lines = Lines(texts)
    return lines.features(0, len(lines.flat)), lines.length, lines.sizes


def _good_share(texts: list[str], weights: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Length-weighted marginal of good over the lines of each text."""
    if not texts:
        return np.zeros(0)
    lines = Lines(texts)
    ranges = range(0, len(lines.flat), SLICE_LINES)
    scores = np.concatenate([lines.features(a, min(a + SLICE_LINES, len(lines.flat))) @ weights for a in ranges])
    good = marginals(scores, trans, lines.sizes)[:, 1]
    weight = lines.length + 1.0
    starts = np.cumsum(lines.sizes) - lines.sizes
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def fit(texts: list[str], quality: list[int]) -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
    """Weights, transitions, and the logistic curve (a, b) of the good share.
    Without documents of both kinds everything scores by their share alone."""
    quality = np.asarray(quality, np.int64)
    if len(quality) == 0 or quality.min() == quality.max():
        one = float(quality.mean()) if len(quality) else 0.5
        return np.zeros((1, 2)), np.zeros((2, 2)), (0.0, 4.0 * (one - 0.5))
    features, _, sizes = line_features(texts)
    weights, trans = fit_chain(features, np.repeat(quality, sizes), sizes, 2)
    share = _good_share(texts, weights, trans)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's method for the logistic curve, slightly regularised
        p = 1 / (1 + np.exp(-(a * share + b)))
        slope = p * (1 - p) + 1e-6
        grad = np.array([((quality - p) * share).sum() - 1e-2 * a, (quality - p).sum() - 1e-2 * b])
        hess = np.array([[(slope * share * share).sum() + 1e-2, (slope * share).sum()], [(slope * share).sum(), slope.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        a, b = a + np.clip(step[0], -5, 5), b + np.clip(step[1], -5, 5)
    return weights, trans, (float(a), float(b))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> list:
    """(text, quality) of at most ``rows`` labelled documents that are not held
    out: those with the smallest id hashes.  Ids labelled both good and bad
    are left out."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", 3, 1))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
              .where("quality = most").drop("most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    out, chars = [], 0
    for r in picked.select("doc_id", "text", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).toLocalIterator():
        chars += len(r.text or "")
        if chars > FIT_CHARS:
            break
        out.append((r.text or "", r.quality))
    return out


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty: one empty line, scored like any other.  Lines
    are split at \\n.  Without labels of both kinds the score is constant.
    Repeated rows are scored one by one; other columns are ignored.
    """
    sample = fit_sample(docs, labels, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit([t for t, _ in sample], [q for _, q in sample]))

    def run(batches):
        weights, trans, (a, b) = model.value
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in chunks(texts):
                share = _good_share(texts[i:j], weights, trans) if len(weights) > 1 else np.zeros(j - i)
                score = np.round(1 / (1 + np.exp(-(a * share + b))), 6)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(score)], ["doc_id", "score"])
    scored = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
