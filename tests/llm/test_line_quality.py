"""Line features, marginals and document scores against plain loops."""

import math
import random

import numpy as np
import pytest

from brute import documents
from tidewater.llm import crf, line_quality as L

LABELS = "doc_id bigint, quality int, toxic int"
RND = random.Random(3)
TEXTS = ["", "\n", "a\n\nb", "x y z!\nx y z!", "É 中 9|\t#"] + [
    "\n".join(RND.choice(["AB c", "d|e #", "", "long words here. " * 3, "no! no? 12"]) for _ in range(RND.randrange(1, 40))) for _ in range(20)]


def own(line, earlier):
    """A line's features, character by character."""
    kinds = [0] * 9
    for c in line:
        kinds[next((k for k, marks in ((4, "#*$%&<>@^~_=+/\\{}[]"), (5, ".,;:"), (6, "!?"), (7, "|")) if c in marks),
                   8 if ord(c) >= 0x3000 else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in " \t\r\x0b\x0c" else 8)] += 1
    words = line.split()
    n, w, letters = max(1, len(line)), max(1, len(words)), max(1, kinds[0] + kinds[1])
    return [k / n for k in kinds] + [
        kinds[1] / letters, min(1, 4 * kinds[4] / w), min(1, 2 * kinds[6] / w), min(1, 2 * kinds[7] / w), math.log1p(len(words)) / 5,
        math.log1p(len(line)) / 7, min(2, len(line) / w / 10), line in earlier, 1 - len(set(words)) / len(words) if words else 0, not line]


def plain_features(text):
    lines = text.split("\n")
    each = [own(line, lines[:i]) for i, line in enumerate(lines)]
    none = [0] * len(each[0])
    return [[1] + e + (each[i - 1] if i else none) + (each[i + 1] if i + 1 < len(each) else none) + [i == 0, i + 1 == len(each)]
            for i, e in enumerate(each)]


def plain_share(text, weights, trans):
    """Sums over the forward and backward products of one chain."""
    scores = np.exp(np.array(plain_features(text), float) @ weights)
    ahead, behind = [scores[0]], [np.ones(2)]
    for s in scores[1:]:
        ahead.append((ahead[-1] @ np.exp(trans)) * s)
        ahead[-1] = ahead[-1] / ahead[-1].sum()
    for s in scores[:0:-1]:
        behind.append(np.exp(trans) @ (s * behind[-1]))
        behind[-1] = behind[-1] / behind[-1].sum()
    both = [a * b for a, b in zip(ahead, behind[::-1])]
    sizes = [len(line) + 1 for line in text.split("\n")]
    return sum(n * p[1] / p.sum() for n, p in zip(sizes, both)) / sum(sizes)


def test_features_by_plain_loops():
    got, length, sizes = L.line_features(TEXTS)
    assert np.allclose(got, np.array([f for t in TEXTS for f in plain_features(t)], float))
    assert sizes.tolist() == [t.count("\n") + 1 for t in TEXTS]


@pytest.mark.parametrize("long_, lines", [(4096, 50_000), (0, 7), (1, 1), (2, 3), (10, 13)])
def test_shares_by_plain_sums(monkeypatch, long_, lines):
    """Also in blocks of positions and slices of lines."""
    monkeypatch.setattr(crf, "LONG", long_)
    monkeypatch.setattr(L, "SLICE_LINES", lines)
    weights = np.random.default_rng(1).normal(size=(len(plain_features("")[0]), 2))
    trans = np.array([[0.7, -0.3], [-0.2, 0.4]])
    assert np.allclose(L._good_share(TEXTS, weights, trans), [plain_share(t, weights, trans) for t in TEXTS])


def test_scores_are_the_fitted_curve_of_the_share(spark):
    texts = [f"Plain words of line {i}.\nAnd more of them." for i in range(30)] + [f"#### $$ {i}\n|| ## !!" for i in range(30)] + [None]
    docs = documents(spark, texts)
    docs = docs.union(docs)  # repeated rows are learned from and scored one by one
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(60)], LABELS)
    sample = L.fit_sample(docs, labels)
    weights, trans, (a, b) = L.fit([t for t, _ in sample], [q for _, q in sample])
    rows = L.quality_scores(docs.repartition(5), labels).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        want = 1 / (1 + math.exp(-(a * plain_share(texts[r.doc_id] or "", weights, trans) + b)))
        assert abs(r.score - want) < 1e-5 and r.predicted == int(r.score >= 0.5)
        assert r.doc_id == 60 or r.predicted == int(r.doc_id < 30)


def test_ids_labelled_both_ways_teach_nothing(spark):
    docs = documents(spark, [f"text {i}" for i in range(40)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(20)] + [(25, 1, 0), (26, None, 0), (None, 0, 1)], LABELS)
    sample = L.fit_sample(docs.repartition(3), labels.repartition(3))
    assert sample == L.fit_sample(docs, labels) and sample
    assert all(q == 1 and int(t.split()[1]) >= 20 for t, q in sample)
