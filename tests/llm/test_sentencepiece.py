"""Ids and decoded text against the sentencepiece library, on whole texts."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brute import clash, documents
from tidewater.llm import catalog, token_counts
from tidewater.llm import sentencepiece as S
from tidewater.llm.common import table

MODEL = S.read_model(S.default_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER = S.Encoder(MODEL)
CASES = [None, "", " ", "   ", "\n", " \n x", "a\tb", "▁a▁▁b", "aaaa" * 50, "é日本語 text\x00z", "<s> </s> <0x0A> <unk>", "🎈🎈",
         "   lead  and   runs    end   ", "ab" * 3000, "a" * 5000, "!!!!!???", "http://www.example.com/aaa?b=c"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdehinorst  \n\té日!*▁AB12🎈"), max_size=80))
def test_any_text(text):
    ids = LIBRARY.encode(text)
    assert ENCODER.encode(text) == ids
    assert ENCODER.decode(ids) == LIBRARY.decode(ids)


def test_long_word_and_forgetting_words():
    rnd = random.Random(4)
    word = "".join(rnd.choice("abcdefgh") for _ in range(20_000))
    assert ENCODER.encode(word) == LIBRARY.encode(word)
    small = S.Encoder(MODEL, memo_words=3)
    for text in ["one two three", "four five six seven", "one eight"]:
        assert small.encode(text) == LIBRARY.encode(text)


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").union(
        documents(spark, CASES).withColumn("doc_id", F.col("doc_id") + 10_000))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = S.encode_report(clash(docs, "n_tokens", "ids")).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert r.decoded_sha256 == digest(LIBRARY.decode(ids))
    one = S.encode(documents(spark, ["some text"])).first()
    assert (list(one.ids), one.decoded) == (LIBRARY.encode("some text"), "some text")
    assert S.encode_report(docs.limit(0)).count() == 0


def test_token_counts_answer_every_limit(spark, sf_dir):
    lengths = sorted(len(LIBRARY.encode(r.text or "")) for r in table(spark, sf_dir, "documents").collect())
    rows = catalog.queries()["op6_token_counts"](spark, sf_dir).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(lengths))
    for r in rows:
        beyond = [n for n in lengths if n >= r.n_tokens]
        within = sum(n <= r.n_tokens for n in lengths)
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(r.n_tokens), len(beyond), sum(beyond))
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)
        assert r.docs_within == within and abs(r.share_within - within / len(lengths)) < 1e-12


def test_token_counts_of_small_tables(spark):
    docs = documents(spark, CASES)
    histogram = token_counts.length_histogram(docs.union(docs))
    lengths = 2 * [len(LIBRARY.encode(t or "")) for t in CASES]
    for limit in (0, 1, 7, 100, 10**6):
        assert token_counts.truncated_total(histogram, limit) == sum(min(n, limit) for n in lengths)
    answers = token_counts.answers(histogram)
    assert token_counts.quantile(answers, 0.5) == sorted(lengths)[len(lengths) // 2 - 1]
    empty = token_counts.length_histogram(docs.limit(0))
    assert token_counts.answers(empty).count() == 0 and token_counts.truncated_total(empty, 5) == 0


def test_unfit_model_is_refused():
    with pytest.raises(Exception):
        S.Vocabulary(b"no model")
