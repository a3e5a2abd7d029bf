"""The pipeline against its stages' own brute-force versions, and its shape."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from brute import DOCS, base_rules, clash, documents, exact_groups
from test_simhash import brute
from tidewater.llm import exact_dedup, mixing, quality_rules as Q, simhash

CLEAN = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(12)]
TEXTS = CLEAN + [CLEAN[0] + " ", CLEAN[1], CLEAN[2].upper(), None, "", "too short", "r s t u v " * 30]


def test_stages_over_a_small_corpus(spark, tmp_path):
    docs = clash(documents(spark, TEXTS), "row", "kept")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    alive = {i: t for i, t in enumerate(TEXTS) if not base_rules(t)[5]}
    at, want = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        at = stage(spark, at, str(tmp_path))
        if k < 4:
            assert at.columns == docs.columns
            at.write.parquet(f"{tmp_path}/{name}")
            at = spark.read.parquet(f"{tmp_path}/{name}")
        want.append(sorted(r.doc_id for r in at.select("doc_id").collect()))
    ratios = Q.log_ratios(docs, Q.trusted_sample(labels))
    good = sorted(r.doc_id for r in Q.rate(docs, ratios, "doc_id").collect() if r.kept)
    assert want[0] == good and set(range(12)) <= set(good) <= set(alive)
    alive = {i: TEXTS[i] for i in good}
    alive = {i: alive[i] for i, v in exact_groups(alive.items()).items() if v[2]}
    assert want[1] == sorted(alive)
    last = sorted({c for _, c in brute(alive).values()})
    assert want[2] == want[3] == want[4] == last
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == last
    assert at.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_rows_come_in_mixture_order(spark, tmp_path):
    """The order of the result is the schedule's, also where a reader packs the
    mixture's files by size; labels keep every document."""
    rnd = random.Random(5)
    rows = [(i, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(20 + 40 * (i % 7))), "en", "abbcccc"[i * 5 % 7], 1) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = [r.doc_id for r in mixing.mixing_plan(docs).orderBy("slot", "place").collect()]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in got] == want and want != sorted(want)
    assert [r.position for r in got] == list(range(600))
    mixing.mixed(docs).write.option("maxRecordsPerFile", 7).parquet(f"{tmp_path}/mixed")
    last = corpus_pipeline.encode_pieces(spark, spark.read.parquet(f"{tmp_path}/mixed"), str(tmp_path))
    assert [r.doc_id for r in last.collect()] == want


def test_empty_corpus(spark, tmp_path):
    documents(spark, ["x"]).where(F.lit(False)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_kept_rows_do_not_depend_on_how_rows_fall(spark):
    """Rows that share id and text but no other column, null ids among them."""
    rows = [(i % 4 if i % 7 else None, CLEAN[i % 4], "en", f"s{i % 5}", i) for i in range(70)]
    docs = clash(spark.createDataFrame(rows, DOCS), "_tie", "row")
    for drop in (exact_dedup.drop_copies, simhash.drop_near_copies):
        kept = [sorted(map(repr, drop(docs.repartition(n)).collect())) for n in (1, 3, 8)]
        assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 4
        assert drop(docs).columns == docs.columns
