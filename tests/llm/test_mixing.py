"""The mixture against its SQL form and against what Pfair promises."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from brute import DOCS, clash, documents
from tidewater.catalog.compare import compare, duckdb_for
from tidewater.llm import catalog, mixing as M


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 499, "b": 300, "c": 200, "d": 1}, {f"s{i}": 1 + i * i % 17 for i in range(40)}])
def test_every_prefix_is_within_one_block(weights):
    period, got = sum(weights.values()), dict.fromkeys(weights, 0)
    plan = M.one_period(weights)
    assert [slot for _, _, slot, _, _ in plan] == list(range(period))
    for source, block, slot, release, deadline in plan:
        assert block == got[source] and release <= slot < deadline
        got[source] += 1
        assert all(abs(got[s] - Fraction(weights[s] * (slot + 1), period)) < 1 for s in weights)
    assert got == weights


def test_oracle(spark, sf_dir):
    assert compare(catalog.queries()["op3_source_mixing"](spark, sf_dir), duckdb_for(sf_dir), catalog.oracles()["op3_source_mixing"]) is None


def test_every_document_once_with_its_columns_in_order(spark):
    rows = [(i, f"t{i}", "en", s, i) for i, s in enumerate(["a"] * 70 + ["b"] * 20 + [None] * 9)] + [(None, None, None, "b", None)]
    docs = clash(spark.createDataFrame(rows, DOCS), "slot", "place", "_s", "row", "block")
    weights = {"a": 2, "b": 1}
    out = M.mixed(docs, weights, block_docs=2)
    assert out.columns == docs.columns
    key = lambda r: (r.doc_id is None, r.doc_id)
    got = out.collect()
    assert sorted(map(key, got)) == sorted(map(key, docs.collect()))
    plan = {(r.doc_id, r.source): (r.slot, r.place) for r in M.mixing_plan(docs, weights, block_docs=2).collect()}
    order = [plan[r.doc_id, r.source or ""] for r in got]
    assert order == sorted(order)


def test_places_of_a_hot_source_and_repeats(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = M.mixing_plan(docs.union(docs)).collect()
    for source in {r.source for r in rows}:
        assert sorted(r.place for r in rows if r.source == source) == list(range(sum(r.source == source for r in rows)))
    assert len({(r.slot, r.place) for r in rows}) == 6000


def test_empty_table_and_bad_weights(spark):
    docs = documents(spark, ["a"])
    assert M.mixing_plan(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.mixing_plan(docs, {"s": 0})


@pytest.mark.parametrize("sizes", [{f"s{i:04}": 2_000_000 if i == 7 else 1000 + i for i in range(3000)}, {"a": 5, "b": 10**9}, {f"s{i}": i + 1 for i in range(40)}])
def test_weights_follow_the_unrounded_targets(sizes):
    weights = M.default_weights(sizes)
    total, period = sum(n ** 0.5 for n in sizes.values()), sum(weights.values())
    targets = {s: n ** 0.5 / total for s, n in sizes.items()}
    # over a period each source is within one block of its unrounded share
    lifted = sum(targets[s] * period < 1 for s in sizes)
    assert period - M.resolution(len(sizes)) <= lifted
    assert all(abs(weights[s] - targets[s] * period) < 1 + lifted * targets[s] for s in sizes)
    done = dict.fromkeys(sizes, 0)
    for s, j, slot, _, _ in M.one_period(weights):
        done[s] += 1
        assert abs(done[s] - targets[s] * (slot + 1)) < 2 + lifted * targets[s]


def test_ids_in_large_steps_and_null_ids_spread(spark):
    for step in (1, 1 << 31, 1 << 40):
        ids = spark.range(4000).select((F.col("id") * step).alias("doc_id"))
        hashes = ids.select(F.shiftright(M.order_hash(), 24).alias("h"))
        assert hashes.distinct().count() > 200
    docs = spark.range(500).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    assert sorted(r.place for r in M.mixing_plan(docs).collect()) == list(range(500))


def test_repeated_ids_come_in_one_order_however_rows_fall(spark):
    rows = [(i % 3, f"t{i % 5}", "en", "ab"[i % 2], i) for i in range(60)]
    docs = clash(spark.createDataFrame(rows, DOCS), "_tie", "_none")
    orders = [[tuple(r) for r in M.mixed(docs.repartition(n)).collect()] for n in (1, 3, 8)]
    assert orders[0] == orders[1] == orders[2] and len(orders[0]) == 60


def test_very_large_weights_are_scaled(spark):
    docs = documents(spark, ["a", "b"])
    assert M.mixing_plan(docs, {"s": 10 ** 12}).count() == 2
    assert M.apportioned({"a": 10 ** 12, "b": 1}, 1000) == {"a": 1000, "b": 1}
