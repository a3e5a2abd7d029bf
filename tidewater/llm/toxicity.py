"""Toxicity of documents: a sentence classifier that identity terms cannot sway.

A document is a bag of sentences (at most ``SENTENCE_WORDS`` words between end
marks; a long text is cut every ``BLOCK_CHARS`` characters).  A sentence's
logit is a sum over its distinct words of hashed weights: one of the word, and
those of its character 4-grams, divided by the root of their number.  The document's score is a logistic curve of its most toxic sentence.

The weights are fitted on sentences of labelled documents: every sentence of a
harmless one is harmless, of a toxic one the sentence now rated highest is
toxic, and both steps alternate.  For each labelled sentence that names a
group, counterfactual sentences swap the identity term for others of its kind;
squared changes of the logit are penalised, so what a group is called neither
makes nor unmakes toxicity.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, held_out

FIT_ROWS = 2_000        # labelled documents of each kind the model is fitted on, at most
FIT_CHARS = 4_000_000   # their characters, at most, half for each kind
SENTENCE_WORDS = 40
BLOCK_CHARS = 500_000   # a longer text is scored block by block
BITS = 18
THRESHOLD = 0.7
PENALTY = 1.0           # weight of the squared change under a swap

# Identity terms by kind (fixed values); a term is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "natives", "locals", "citizens"),
    ("disabled", "deaf", "blind", "elderly", "young", "old"),
    ("americans", "mexicans", "chinese", "germans", "russians", "arabs"),
)

# Character kinds: 0 part of a word, 1 between words, 2 end of a sentence.
_KINDS: list[np.ndarray] = []
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _kinds() -> np.ndarray:
    """Kinds of the code points; beyond U+2FFF all are part of words but for
    the full-width end marks."""
    if not _KINDS:
        out = np.zeros(0x110000, np.uint8)
        for c in range(0x3000):
            out[c] = 0 if chr(c).isalnum() else 1
        for mark in ".!?\n。！？":
            out[ord(mark)] = 2
        out[ord("　")] = 1
        _KINDS.append(out)
    return _KINDS[0]


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    """Table places of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(29)) ^ np.uint64(salt)) * _MIX
    return ((h ^ (h >> np.uint64(32))) * _STEP >> np.uint64(64 - BITS)).astype(np.int64)


class Words:
    """The words of several texts as flat arrays.

    ``word`` holds each word's table place, ``grams`` and ``owner`` the places
    of all 4-grams and the word of each, ``sentence`` each word's sentence,
    ``text`` each sentence's text; texts without words have no sentence.
    ``counts`` is true for a word's first place in its sentence.
    """

    def __init__(self, texts: Sequence[str]):
        # A sentence mark ends each text, and a blank precedes the first.
        joined = " " + "".join(t.lower() + "\n" for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[points]
        inside = kind == 0
        first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        last = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        self.spans = np.column_stack([first, last])
        self.joined = joined
        code = np.where(inside, points, 1).astype(np.uint64)
        # Whole words: a polynomial in the places of their characters.
        letters = np.flatnonzero(inside)
        word_of = np.repeat(np.arange(len(first)), last - first)
        if len(first):
            power = (code[letters] + np.uint64(7)) * _powers(letters - first[word_of])
            self.word = _slot(np.add.reduceat(power, np.cumsum(last - first) - (last - first)), 17)
        else:
            self.word = np.zeros(0, np.int64)
        # 4-grams of a word and the blank on either side (a one-letter word
        # has none).
        gram = code.copy()
        for k in (1, 2, 3):
            gram[:-k] = gram[:-k] * _STEP + code[k:]
        start = letters - 1
        whole = start + 3 <= last[word_of]
        start, self.owner = start[whole], word_of[whole]
        self.grams = _slot(gram[start], 23)
        # Sentences: a mark or forty words end one.
        marks = np.cumsum(kind == 2)
        part = marks[first] if len(first) else np.zeros(0, np.int64)
        new = np.r_[True, part[1:] != part[:-1]] if len(part) else np.zeros(0, bool)
        opening = np.maximum.accumulate(np.where(new, np.arange(len(part)), 0)) if len(part) else np.zeros(0, np.int64)
        new |= (np.arange(len(part)) - opening) % SENTENCE_WORDS == 0
        self.sentence = np.cumsum(new) - 1
        sizes = np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes) + 1
        self.text = np.searchsorted(ends, first[new], side="right")
        self.texts = len(texts)
        self.counts = np.zeros(len(first), bool)
        self.counts[np.unique((self.sentence << BITS) + self.word, return_index=True)[1]] = True

    def text_of_word(self, i: int) -> str:
        return self.joined[self.spans[i, 0]:self.spans[i, 1]]

    def gram_weight(self) -> np.ndarray:
        """What each 4-gram counts: one over the root of its word's number of them."""
        return (1 / np.sqrt(np.maximum(1, np.bincount(self.owner, minlength=len(self.word)))))[self.owner]

    def sentence_logits(self, weights: np.ndarray) -> np.ndarray:
        per_word = weights[self.word] + np.bincount(self.owner, weights[self.grams] * self.gram_weight(), len(self.word))
        return np.bincount(self.sentence, np.where(self.counts, per_word, 0.0), len(self.text))


def _powers(places: np.ndarray) -> np.ndarray:
    """Odd multipliers by place within a word."""
    z = (places.astype(np.uint64) + np.uint64(1)) * _STEP
    z = (z ^ (z >> np.uint64(30))) * _MIX
    return (z ^ (z >> np.uint64(27))) | np.uint64(1)


def top_logits(words: Words, logits: np.ndarray) -> np.ndarray:
    """The highest sentence logit of each text; zero without sentences."""
    top = np.zeros(words.texts)
    if len(logits):
        starts = np.flatnonzero(np.r_[True, words.text[1:] != words.text[:-1]])
        top[words.text[starts]] = np.maximum.reduceat(logits, starts)
    return top


def _features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, place, value) of all features of all sentences."""
    once, of_gram = words.counts, words.counts[words.owner]
    return (np.r_[words.sentence[once], words.sentence[words.owner[of_gram]]], np.r_[words.word[once], words.grams[of_gram]],
            np.r_[np.ones(once.sum()), words.gram_weight()[of_gram]])


def swaps(words: Words, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[tuple[str, str, int]]:
    """(term, other term of its kind, occurrences) over all words."""
    kind = {t: group for group in terms for t in group}
    # Words are looked at by their table place first.
    places = np.unique(Words([" ".join(kind)]).word)
    found: dict[str, int] = {}
    for i in np.flatnonzero(np.isin(words.word, places)):
        text = words.text_of_word(i)
        if text in kind:
            found[text] = found.get(text, 0) + 1
    return [(t, other, n) for t, n in sorted(found.items()) for other in kind[t] if other != t]


def swap_differences(pairs: list[tuple[str, str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse changes of a sentence's features under each swap (pair, place,
    value) and how often the swap applies.  A sentence's logit is a sum over
    words, so the change is the same in every sentence."""
    pair, place, value = [], [], []
    for k, (term, other, _) in enumerate(pairs):
        for word, sign in ((term, 1.0), (other, -1.0)):
            w = Words([word])
            pair += [k] * (1 + len(w.grams))
            place += [int(w.word[0]), *w.grams.tolist()]
            value += [sign, *(sign * w.gram_weight()).tolist()]
    return np.array(pair, np.int64), np.array(place, np.int64), np.array(value), np.array([n for _, _, n in pairs], np.float64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _descend(feats, y, importance, weights, bias, changes, penalty, steps=60, rate=0.4, sparse=5e-5):
    """AdaGrad with soft thresholds on the logistic loss of the sentences plus
    the penalised changes under swaps."""
    rows, places, values = feats
    used, at = np.unique(places, return_inverse=True)
    pair, place, change, often = changes
    inner = np.searchsorted(used, place)
    known = (inner < len(used)) & (used[np.minimum(inner, len(used) - 1)] == place) if len(used) else np.zeros(len(place), bool)
    w, seen, seen_b = weights[used].copy(), np.full(len(used), 1e-8), 1e-8
    # Both kinds weigh the same together.
    importance = importance / np.where(y == 1, importance[y == 1].sum(), importance[y == 0].sum()) / 2
    for _ in range(steps if len(rows) else 0):
        p = _sigmoid(np.bincount(rows, w[at] * values, len(y)) + bias)
        off = (p - y) * importance
        grad = np.bincount(at, off[rows] * values, len(used))
        if len(often):
            moved = np.bincount(pair[known], w[inner[known]] * change[known], len(often))
            pull = 2 * penalty * moved * often / often.sum()
            grad += np.bincount(inner[known], pull[pair[known]] * change[known], len(used))
        seen += grad ** 2
        size = rate / np.sqrt(seen)
        w = w - size * grad
        w = np.sign(w) * np.maximum(np.abs(w) - size * sparse, 0)
        grad_b = off.sum()
        seen_b += grad_b ** 2
        bias -= rate * grad_b / np.sqrt(seen_b)
    out = np.zeros(1 << BITS)
    out[used] = w
    return out, float(bias)


class Model:
    """Hashed weights, the sentences' bias and the documents' curve."""

    def __init__(self, weights: np.ndarray, bias: float, curve: tuple[float, float]):
        self.weights, self.bias, self.curve = weights, bias, curve

    def logits(self, texts: Sequence[str]) -> np.ndarray:
        """The highest sentence logit of each text, block by block; without
        words that of no evidence."""
        blocks = [t[i:i + BLOCK_CHARS] for t in texts for i in range(0, max(1, len(t)), BLOCK_CHARS)]
        owner = np.repeat(np.arange(len(texts)), [max(1, -(-len(t) // BLOCK_CHARS)) for t in texts])
        best = np.full(len(texts), -np.inf)
        for i, j in chunks(blocks, BLOCK_CHARS):
            words = Words(blocks[i:j])
            logit = top_logits(words, words.sentence_logits(self.weights) + self.bias)
            wordless = np.bincount(words.text, minlength=j - i) == 0
            np.maximum.at(best, owner[i:j], np.where(wordless, -np.inf, logit))
        return np.where(np.isfinite(best), best, self.bias)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        a, b = self.curve
        return _sigmoid(a * self.logits(texts) + b)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve (slope at least zero) by Newton's method, slightly regularised."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        s = p * (1 - p) + 1e-6
        grad = np.array([((y - p) * x).sum() - 0.1 * (a - 1), (y - p).sum() - 0.1 * b])
        hess = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum() + 0.1]])
        move = np.linalg.solve(hess, grad)
        a, b = max(0.0, a + float(np.clip(move[0], -2, 2))), b + float(np.clip(move[1], -2, 2))
    return a, b


def fit(texts: Sequence[str], toxic: Sequence[int], penalty: float = PENALTY, terms: Sequence[Sequence[str]] = IDENTITY_TERMS, rounds: int = 3) -> Model:
    """The model of labelled texts.  Without texts of both kinds every text
    scores the share of toxic ones (one half without any)."""
    y = np.asarray(toxic, np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return Model(np.zeros(1 << BITS), 0.0, (0.0, float(np.log(share / (1 - share)))))
    words = Words(texts)
    feats, changes = _features(words), swap_differences(swaps(words, terms))
    label = y[words.text]
    per_text = np.bincount(words.text, minlength=len(y))
    # First every sentence of a toxic text is toxic, by its share of the text.
    importance = 1 / np.maximum(1, per_text)[words.text]
    weights, bias = np.zeros(1 << BITS), 0.0
    for k in range(rounds):
        weights, bias = _descend(feats, label, importance, weights, bias, changes, penalty)
        if k + 1 < rounds:
            logits = words.sentence_logits(weights)
            top = top_logits(words, logits)
            # Of toxic texts the highest sentence alone, of others all.
            importance = np.where(label == 1, logits >= top[words.text], 1 / np.sqrt(np.maximum(1, per_text))[words.text])
    model = Model(weights, bias, (1.0, 0.0))
    return Model(weights, bias, _curve(model.logits(texts), y))


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> list[tuple[str, int]]:
    """(text, toxic) of at most ``rows`` documents of each kind that are not
    held out: those with the smallest id hashes.  A document labelled both
    ways counts as toxic."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", 3, 1))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("toxic = 0").orderBy(*order).limit(rows).unionByName(known.where("toxic = 1").orderBy(*order).limit(rows))
    picked = docs.select(docs["doc_id"], docs["text"]).join(F.broadcast(chosen), "doc_id")
    out, left = [], {0: chars // 2, 1: chars // 2}
    for r in picked.orderBy(*order, "text").limit(2 * rows).toLocalIterator():
        text = r.text or ""
        if len(text) <= left[r.toxic]:
            left[r.toxic] -= len(text)
            out.append((text, r.toxic))
    return out


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, penalty: float = PENALTY) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from 0.7).

    The model is fitted on at most ``fit_rows`` labelled documents of each
    kind; every document is scored over all its sentences.  Null text counts
    as empty; a text without words scores like a sentence of unknown words.  Without
    labels of both kinds the score is constant.  Repeated rows are scored one
    by one; other columns are ignored; an empty table gives no rows.
    """
    sample = fit_sample(docs, labels, fit_rows)
    model = docs.sparkSession.sparkContext.broadcast(fit([t for t, _ in sample], [y for _, y in sample], penalty))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for i, j in chunks(texts):
                score = np.round(model.value.scores(texts[i:j]), 6)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(score)], ["doc_id", "score"])
    scored = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
