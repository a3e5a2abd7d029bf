"""Exact dedup against a plain grouping, collisions and awkward tables."""

import pytest
from pyspark.sql import functions as F

from brute import DOCS, clash, documents, exact_groups
from tidewater.catalog.compare import compare, duckdb_for
from tidewater.llm import catalog, exact_dedup

TEXTS = ["a b", "ab", "a\tb ", None, "", " \n", "x" * 200_000, "ab ", "É", "é", "ab"] + ["same text"] * 40


def as_dict(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_grouping(spark):
    docs = documents(spark, TEXTS)
    assert as_dict(exact_dedup.exact_groups(docs)) == exact_groups(enumerate(TEXTS))


@pytest.mark.parametrize("share", [0, 4])
def test_owners_compare_what_did_not_collapse(spark, monkeypatch, share):
    """No key, or only those on a fourth of all rows, collapse beforehand."""
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    docs = documents(spark, TEXTS + [f"text {i % 7}" for i in range(30)]).repartition(6)
    want = exact_groups([tuple(r) for r in docs.select("doc_id", "text").collect()])
    weak = lambda norm: F.pmod(F.xxhash64(norm), F.lit(2))
    assert as_dict(exact_dedup.exact_groups(docs, capacity=1)) == want
    assert as_dict(exact_dedup.exact_groups(docs, capacity=2, key=weak)) == want


def test_documents_are_looked_up_through_the_directory(spark, monkeypatch):
    docs = documents(spark, [f"text {i}" for i in range(60)])
    index, directory, start = exact_dedup._indexed(docs, 8, F.xxhash64)
    files = index.select("bucket", "depth", F.input_file_name().alias("file")).distinct().collect()
    assert len(files) == len({(r.bucket, r.depth) for r in files}) == directory.count() > 4
    split = exact_dedup.split_directory
    monkeypatch.setattr(exact_dedup, "split_directory", lambda *a: (split(*a)[0].limit(0), split(*a)[1]))
    assert exact_dedup.exact_groups(docs, 8).count() == 0


def test_colliding_hashes_stand_in_one_chain(spark):
    """With four hash values for all texts, bytes alone tell texts apart."""
    docs = documents(spark, TEXTS + [f"text {i}" for i in range(60)])
    weak = lambda norm: F.pmod(F.xxhash64(norm), F.lit(4))
    want = exact_groups([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert as_dict(exact_dedup.exact_groups(docs, capacity=2, key=weak)) == want
    index = exact_dedup.build_index(docs, capacity=2, key=weak).collect()
    assert len({(r.key, r.chain) for r in index}) == len(index)


def test_directory_splits_only_overfull_buckets(spark):
    docs = documents(spark, [f"text {i}" for i in range(500)])
    index = exact_dedup.build_index(docs, capacity=16)
    sizes = index.groupBy("depth", "bucket").count().collect()
    assert max(r["count"] for r in sizes) <= 16
    assert len({r.depth for r in sizes}) > 1
    assert sum(2.0 ** -r.depth for r in sizes) <= 1.0
    assert index.count() == 500


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(spark):
    docs = clash(documents(spark, TEXTS), "key", "kept", "row", "_k")
    out = exact_dedup.drop_copies(docs.union(docs))
    assert out.columns == docs.columns
    want = sorted(i for i, v in exact_groups(enumerate(TEXTS)).items() if v[2])
    assert sorted(r.doc_id for r in out.collect()) == want


def test_null_ids_empty_table_and_repeats(spark):
    docs = spark.createDataFrame([(None, "t", None, None, None), (5, "t", None, None, None), (None, "u", None, None, 1),
                                  (-3, "v", "en", "s", 1), (-9, "v", "en", "s", 1)], DOCS)
    got = sorted(((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_groups(docs).collect()), key=repr)
    assert got == sorted([(None, 5, False), (5, 5, True), (None, None, True), (-3, -9, False), (-9, -9, True)], key=repr)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0
    assert exact_dedup.drop_copies(docs.limit(0)).columns == docs.columns


def test_runs_without_python(spark, sf_dir):
    plan = catalog.queries()["op1_exact_dedup"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", ["op1_exact_dedup"])
def test_oracle(spark, sf_dir, name):
    assert compare(catalog.queries()[name](spark, sf_dir), duckdb_for(sf_dir), catalog.oracles()[name]) is None
