"""Quality rules against plain counting, and the ratio against its definition."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from brute import WORD, base_rules, clash, documents
from tidewater.llm import catalog, quality_rules as Q
from tidewater.llm.common import table

TEXTS = [None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "# * <x> $5 | & %",
         "line\nline\n\n \nline \n line", "\x0b\x0ca\rb c d", "w " * 30_000, " ".join(map(str, range(40))),
         "p q r s t u v p q r s t u v w x y z " + " ".join(map(str, range(100)))]


def test_base_matches_counting(spark, sf_dir):
    docs = documents(spark, TEXTS).union(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id") + 1000))
    out = Q.rate(docs.repartition(4), [0.0] * Q.BUCKETS, "doc_id")
    rows = out.join(docs.select("doc_id", F.col("text").alias("whole")), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == base_rules(r.whole), r.doc_id


def test_ratio_is_the_mean_log_ratio(spark):
    docs = documents(spark, ["good words here now", "bad $$$ words", "good day", None])
    labels = spark.createDataFrame([(0, 1, 0), (2, 1, 0), (1, 0, 0), (3, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    ratios = Q.log_ratios(docs, Q.trusted_sample(labels))
    grams = {r.doc_id: [g & (Q.BUCKETS - 1) for g in r.hashes + r.pairs] for r in Q.with_grams(docs, "doc_id").collect()}
    raw, target = Counter(g for v in grams.values() for g in v), Counter(grams[0] + grams[2])
    n_raw, n_target = sum(raw.values()) + Q.BUCKETS, sum(target.values()) + Q.BUCKETS
    want = lambda b: math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw)
    assert all(abs(ratios[b] - want(b)) < 1e-5 for b in range(Q.BUCKETS))
    for r in Q.rate(docs, ratios, "doc_id").collect():
        mean = sum(want(b) for b in grams[r.doc_id]) / max(1, len(grams[r.doc_id]))
        assert abs(r.llr - mean) < 1e-5


def test_junk_goes_and_clean_stays(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    rated = catalog.queries()["op5_quality_rules"](spark, sf)
    rows = rated.where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert len(junk) > 20 and sum(junk) <= 0.15 * len(junk)


def test_threshold_follows_the_labels(spark):
    """Junk in part, rated above -0.4, goes; repeats of texts change nothing."""
    rnd = random.Random(1)
    clean = [" ".join(f"c{rnd.randrange(30)}" for _ in range(20)) for _ in range(40)]
    junk = [" ".join(clean[i].split()[:14] + [f"j{i}x{j}" for j in range(6)]) for i in range(10)]
    docs = documents(spark, clean + junk + [clean[3]] * 200)
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(50)], "doc_id bigint, quality int, toxic int")
    rows = Q.quality_report(docs, labels).collect()
    assert all(r.kept == (r.doc_id < 40 or r.doc_id >= 50) for r in rows)
    assert any(r.llr > -0.4 for r in rows if 40 <= r.doc_id < 50)
    assert sorted(r.doc_id for r in Q.keep_good(docs, labels).collect()) == [r for r in range(250) if not 40 <= r < 50]
    once = {r.doc_id: (r.llr, r.kept) for r in Q.quality_report(docs.where("doc_id < 50"), labels).collect()}
    assert once == {r.doc_id: (r.llr, r.kept) for r in rows if r.doc_id < 50}


def test_separating_threshold():
    assert Q.separating([(1, -20, 5), (1, 10, 90), (0, -200, 3), (0, 0, 2)]) == (-199 - 20) / 2 / Q.STEPS
    assert Q.separating([(1, -300, 1), (1, -20, 2999), (0, -100, 1)]) == (-99 - 20) / 2 / Q.STEPS
    assert Q.separating([(1, 5, 1)]) == Q.separating([(0, 5, 1)]) == Q.THRESHOLD


def test_clashing_columns_and_empty_tables(spark):
    docs = clash(documents(spark, TEXTS), "kept", "words", "trusted", "row", "quality")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = Q.keep_good(docs, labels)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i, t in enumerate(TEXTS) if not base_rules(t)[5]]
    assert Q.quality_report(docs.limit(0), labels).count() == 0
    assert Q.quality_report(docs.union(docs), labels).count() == 2 * len(TEXTS)


def test_runs_without_python(spark, sf_dir):
    plan = catalog.queries()["op5_quality_rules"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
