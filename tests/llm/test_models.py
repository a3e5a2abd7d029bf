"""Learned operators: the chain against enumeration, the fixed patterns against
plain regular expressions, held-out accuracy, and awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import clash, documents
from tidewater.llm import catalog, crf, language_id, line_quality, pii
from tidewater.llm.common import table

SF = "/root/testdata/sf0.01"
TEXTS = [None, "", " \n\n ", "12345 !!", "word", "x" * 60_000, "a\nb\n" * 3000, "½ ² ٣", "日本語 テキスト", "The and of the to is in that."]


def test_chain_matches_enumeration():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 1, 4, 0, 2])
    scores, trans = rng.normal(size=(10, 3)), rng.normal(size=(3, 3))
    best, marginal = crf.viterbi(scores, trans, sizes), crf.forward_backward(scores, trans, sizes)
    at = 0
    for n in sizes[sizes > 0].tolist():
        paths = list(itertools.product(range(3), repeat=n))
        weight = np.array([sum(scores[at + i, p[i]] for i in range(n)) + sum(trans[a, b] for a, b in itertools.pairwise(p)) for p in paths])
        share = np.exp(weight - weight.max())
        share /= share.sum()
        assert tuple(best[at:at + n]) == paths[weight.argmax()]
        for i, k in itertools.product(range(n), range(3)):
            assert abs(marginal[at + i, k] - sum(s for s, p in zip(share, paths) if p[i] == k)) < 1e-9
        at += n


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = {k: [] for k in PATTERNS}
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m.group() if "0" <= c <= "9")
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out[kind].append(m.span())
    return out


def test_fixed_patterns_match_plain_ones():
    rnd = random.Random(3)
    parts = ["4111111111111111", "4111 1111 1111 1111", "+1 (743) 555-3824", "1.2.3.4", "a@b.c", "_x", " ", ".", "256.1.1.1", "-", "é", "\n"]
    texts = ["".join(rnd.choice("ab@.-_1290 +()5\n") for _ in range(rnd.randint(0, 40))) for _ in range(20_000)]
    texts += ["".join(rnd.choices(parts, k=rnd.randint(0, 9))) for _ in range(2000)]
    assert all(pii.base_spans(t) == plain_spans(t) for t in texts)


def test_personal_data_over_the_table(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    for r in catalog.queries()["op4_personal_data"](spark, sf_dir).collect():
        base = plain_spans(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in pii.KINDS)
        flat = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert set(flat) <= set(r.spans.split(",") if r.spans else [])


def test_chain_adds_what_patterns_miss(spark):
    texts = ["reach me: anna dot b at example dot com thanks", "call (555) 123-4567 now", "nothing at all dot here", "meet at noon. Dot com boom",
             "number 2123465659789240 x", "paid 4929 1234 today", "+1 (269) 555-3296 4524132264652876 erntou"]
    got = {r.doc_id: [(s.split(":")[0], texts[r.doc_id][int(s.split(":")[1]):int(s.split(":")[2])]) for s in r.spans.split(",") if s]
           for r in pii.personal_data(documents(spark, texts)).collect()}
    assert got[0] == [("email", "anna dot b at example dot com")]
    assert got[1] == [("phone", "(555) 123-4567")]
    assert got[2] == got[3] == got[4] == got[5] == []
    assert ("card", "4524132264652876") in got[6]


def test_learned_operators_on_awkward_tables(spark):
    docs = clash(documents(spark, TEXTS), "score", "held_out", "predicted", "spans")
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (9, 1, 0), (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    for out, columns in [(language_id.language_report(docs), ["doc_id", "held_out", "lang_pred", "score", "rejected"]),
                         (line_quality.quality_scores(docs, labels), ["doc_id", "held_out", "score", "predicted"]),
                         (line_quality.quality_scores(docs, labels.limit(0)), ["doc_id", "held_out", "score", "predicted"]),
                         (pii.personal_data(docs), pii.RESULT.names)]:
        rows = out.collect()
        assert out.columns == columns and len(rows) == len(TEXTS)
        assert all(0 <= r.score <= 1 for r in rows if "score" in columns)
    got = {r.doc_id: r.lang_pred for r in language_id.language_report(docs).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 7)] == ["und"] * 5 and got[4] == got[9] == "en"
    assert language_id.language_report(docs.limit(0)).count() == 0
    assert line_quality.quality_scores(docs.limit(0), labels).count() == 0
    none = language_id.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_held_out_language(spark):
    rows = catalog.queries()["op2_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    out = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(out) > 100 and sum(out) >= 0.98 * len(out)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_held_out_quality(spark):
    rows = catalog.queries()["op9_line_quality"](spark, SF).join(table(spark, SF, "labels"), "doc_id").collect()
    out = [(r.quality, r.predicted) for r in rows if r.held_out]
    assert len(out) > 100 and sum(a == b for a, b in out) >= 0.95 * len(out)


def plain_model(texts):
    """Interpolated Kneser-Ney over the padded words of texts: a function from
    (context, character) to probability, backing off like the operator."""
    D, grams = language_id.DISCOUNT, [Counter() for _ in range(5)]
    for t in texts:
        for w in language_id.words_of(t):
            w = "\x01\x01\x01" + w + "\x02"
            grams[4].update(w[i - 3:i + 1] for i in range(3, len(w)))
    for order in (3, 2, 1):
        grams[order] = Counter(g[1:] for g in grams[order + 1])
    totals, kinds = [Counter() for _ in range(5)], [Counter() for _ in range(5)]
    for order in range(1, 5):
        for g, c in grams[order].items():
            totals[order][g[:-1]] += c
            kinds[order][g[:-1]] += 1

    def logp(gram, floor):
        order = len(gram)
        if order == 0:
            return floor
        if gram in grams[order]:
            return math.log(prob(gram))
        back = math.log(D * kinds[order][gram[:-1]] / totals[order][gram[:-1]]) if gram[:-1] in totals[order] else 0.0
        return back + logp(gram[1:], floor)

    def prob(gram):
        order, ctx = len(gram), gram[:-1]
        under = 1 / (len(grams[1]) + 1) if order == 1 else prob(gram[1:])
        return max(grams[order][gram] - D, 0) / totals[order][ctx] + D * kinds[order][ctx] / totals[order][ctx] * under
    return logp, len(grams[1]) + 1


def plain_entropies(rows):
    train = {}
    for r in rows:
        if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            train.setdefault(r.lang, []).append(r.text)
    models = {lang: plain_model(texts) for lang, texts in train.items()}
    floor, out = -math.log(max(units for _, units in models.values())), {}
    for r in rows:
        words = language_id.words_of(r.text or "")
        padded = ["\x01\x01\x01" + w + "\x02" for w in words]
        units = sum(len(w) + 1 for w in words)
        out[r.doc_id] = [-sum(models[lang][0](w[i - 3:i + 1], floor) for w in padded for i in range(3, len(w))) / units for lang in sorted(models)] if units else None
    return out


@pytest.mark.parametrize("shard_bytes", [64 << 20, 60_000])
def test_cross_entropies_match_plain_kneser_ney(spark, sf_dir, monkeypatch, shard_bytes):
    """Over the whole small table, also with the grams in many shards."""
    monkeypatch.setattr(language_id, "SHARD_BYTES", shard_bytes)
    docs = table(spark, sf_dir, "documents")
    docs = docs.unionByName(documents(spark, ["zebra zeal", "ölig \U0001d4d0x", "", None], lang="rare").withColumn("doc_id", F.col("doc_id") + 10 ** 6))
    rows = docs.collect()
    want = plain_entropies(rows)
    scored, langs = language_id.entropies(docs)
    got = {r.doc_id: r.entropies for r in scored.collect()}
    assert langs == sorted({r.lang for r in rows if r.lang is not None}) and len(got) == len(want)
    for doc_id, e in want.items():
        assert (e is None and got[doc_id] is None) or np.allclose(got[doc_id], e, rtol=0, atol=1e-9), doc_id


def test_limits_cover_every_language(spark):
    """A language with two documents among hundreds has a limit of its own."""
    docs = documents(spark, [f"the and of to in {'is that this ' * (i % 9)}" for i in range(300)])
    rare = spark.createDataFrame([(10 ** 6 + i, "zebra zool zing " * 3, "zz", "s", 1) for i in range(8)], docs.schema)
    scored, langs = language_id.entropies(docs.unionByName(rare))
    limits, sharpness = language_id.calibration(scored, langs)
    assert set(limits) == {"en", "zz"} and all(0 < x < 10 for x in limits.values()) and sharpness in language_id.SHARPNESS
    own = {r.doc_id: r for r in scored.where("lang is not null").collect()}
    for lang, limit in limits.items():
        e = np.array([r.entropies[langs.index(lang)] for r in own.values() if r.lang == lang])
        assert np.isclose(limit, max(e.mean() + 4 * e.std(), 1.2 * e.max()))


def test_repeated_rows_and_input_order_of_language_id(spark):
    docs = documents(spark, TEXTS + ["le chat et la souris dans la maison", "der hund und die katze"] * 3)
    docs = docs.withColumn("lang", F.when(F.col("text").startswith("le"), "fr").when(F.col("text").startswith("der"), "de").otherwise("en"))
    twice = docs.unionByName(docs)
    one, other = (sorted(map(tuple, language_id.language_report(d).collect()), key=repr) for d in (twice, twice.orderBy(F.rand(4)).repartition(5)))
    assert one == other and len(one) == 2 * docs.count()


