"""The toxicity model: features and scores against plain loops, the effect of
the counterfactual penalty, held-out accuracy, and awkward tables."""

import random

import numpy as np
from pyspark.sql import functions as F

from brute import clash, documents
from tidewater.llm import toxicity
from tidewater.llm.common import table

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"
TEXTS = ["", "...", "a", "Hello world. Bad day!", "one\ntwo two  two", "日本語。テキスト", "x" * 5000, "½ ²", "w " * 100, "İstanbul ŉ ß"]


def plain_words(text):
    """[(sentence, word)] of a lower-cased text."""
    out, sentence, count, word = [], 0, 0, ""
    for ch in text.lower() + "\n":
        inside = ord(ch) >= 0x3000 and ch not in "。！？　" or ord(ch) < 0x3000 and ch.isalnum()
        if inside:
            word += ch
            continue
        if word:
            if count == toxicity.SENTENCE_WORDS:
                sentence, count = sentence + 1, 0
            out.append((sentence, word))
            word, count = "", count + 1
        if ch in ".!?\n。！？" and count:
            sentence, count = sentence + 1, 0
    return out


def plain_logit(text, weights, bias):
    """Each distinct word's weight, looked up alone, summed by sentence."""
    sums = {}
    for sentence, word in set(plain_words(text)):
        w = toxicity.Words([word])
        assert len(w.word) == 1 and len(w.grams) == len(word) - 1
        value = weights[w.word[0]] + weights[w.grams].sum() / np.sqrt(max(1, len(w.grams)))
        sums[sentence] = sums.get(sentence, 0.0) + value
    return max(sums.values()) + bias if sums else bias


def test_scores_match_plain_sums():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=1 << toxicity.BITS)
    rnd = random.Random(1)
    texts = TEXTS + ["".join(rnd.choice("ab. \n!é日") for _ in range(rnd.randint(0, 300))) for _ in range(200)]
    got = toxicity.Model(weights, -0.5, (1.0, 0.0)).logits(texts)
    want = [plain_logit(t, weights, -0.5) for t in texts]
    assert np.allclose(got, want)


def test_long_texts_are_scored_block_by_block(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 50)
    weights = np.random.default_rng(2).normal(size=1 << toxicity.BITS)
    model = toxicity.Model(weights, 0.0, (1.0, 0.0))
    text = "some words here and there. " * 40 + "worst of all words"
    blocks = [text[i:i + 50] for i in range(0, len(text), 50)]
    assert np.isclose(model.logits([text])[0], max(plain_logit(b, weights, 0.0) for b in blocks))


def group_corpus(rnd, n):
    """Toxic sentences often name women, harmless ones seldom do."""
    filler = ["river", "table", "green", "walk", "music", "bread", "cloud", "story", "road", "paper"]
    texts, toxic = [], []
    for i in range(n):
        bad = i % 2
        words = rnd.choices(filler, k=8) + (["idiots"] if bad and rnd.random() < 0.8 else []) + (["women"] if rnd.random() < (0.9 if bad else 0.05) else [])
        rnd.shuffle(words)
        texts.append(" ".join(words))
        toxic.append(bad)
    return texts, toxic


def test_penalty_spares_neutral_mentions_of_a_group():
    texts, toxic = group_corpus(random.Random(0), 600)
    neutral, insult = "the women walk along the river", "the idiots walk along the river"
    plain, fair = toxicity.fit(texts, toxic, penalty=0.0), toxicity.fit(texts, toxic)
    gap = lambda m: abs(m.logits([neutral])[0] - m.logits([neutral.replace("women", "men")])[0])
    assert gap(fair) < 0.2 * gap(plain)
    assert plain.scores([neutral])[0] > 0.5 > fair.scores([neutral])[0]
    assert fair.scores([insult])[0] > fair.scores([neutral])[0] + 0.3


def test_swaps_are_those_of_the_labelled_sentences():
    words = toxicity.Words(["Women and men. women", "gay"])
    got = toxicity.swaps(words, [("women", "men", "boys"), ("gay", "straight"), ("black", "white")])
    assert got == [("gay", "straight", 1), ("men", "women", 1), ("men", "boys", 1), ("women", "men", 2), ("women", "boys", 2)]


def test_held_out_accuracy(spark):
    """Some 280 toxic documents in four languages to learn from."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id")
    rows = scored.where("held_out and toxic in (0, 1)").select("score", "predicted", "toxic").collect()
    bad, good = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in bad) >= 0.6 * len(bad) and sum(r.predicted for r in good) <= 0.015 * len(good)
    ranked = np.mean([x.score > y.score for x in bad for y in good])
    assert ranked >= 0.95


def test_awkward_tables(spark):
    docs = clash(documents(spark, [None, *TEXTS, *TEXTS]).unionByName(documents(spark, ["idiot"])), "score", "toxic", "held_out", "predicted")
    labels = clash(spark.createDataFrame([(i, None, i % 2) for i in range(20)] + [(3, 1, 0), (None, 1, 1), (4, 1, None)], LABELS), "text", "score")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    empty = [r.score for r in got if r.doc_id in (0, 1) and r.score is not None]
    assert empty[0] == empty[1]
    shuffled = toxicity.toxicity_scores(docs.orderBy(F.rand(2)).repartition(3), labels.orderBy(F.rand(5))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, shuffled))
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    only = toxicity.toxicity_scores(docs, labels.where("toxic = 0")).collect()
    assert {r.predicted for r in only} == {0}
