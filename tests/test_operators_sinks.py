"""Operators, sinks and the streaming path on small inputs."""

import pytest
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import operators as op
from tidewater import streaming as st
from tidewater.plans import weather
from tidewater.session import scratch_path
from tidewater.sinks import tables as snk


def test_deduplicate_newest_with_total_tiebreak(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 3, "a"), (1, 1, "z"), (2, None, "q"), (2, 0, "r")],
                               "k int, t int, v string")
    got = sorted(tuple(r) for r in op.deduplicate(df, ["k"], "t desc, v").collect())
    assert got == [(1, 3, "a"), (2, 0, "r")]       # NULL never wins


def test_explode_tolerant_and_strict(spark):
    docs = spark.createDataFrame([('[{"id":1}, 2, "s", null, [1]]',), ('{"id":2}',), ("{bad",),
                                  (None,), ("[]",), ("7",)], "raw_json string")
    tol = sorted(r.i for r in op.explode_tolerant(docs).select(
        F.expr("cast(variant_get(obj, '$.id', 'int') as int)").alias("i")).collect())
    assert tol == [1, 2]
    good = docs.where(~F.col("raw_json").startswith("{bad") & F.col("raw_json").isNotNull())
    strict = op.explode_strict(good).count()
    assert strict == 1                               # object roots are skipped
    with pytest.raises(Exception):
        op.explode_strict(docs).count()              # unparsable text fails


def test_unnest_drops_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, a array<int>")
    assert op.unnest(df, "a", "x").count() == 2


def test_append_idempotent_and_not_null(spark):
    target = scratch_path(spark, "t_append")
    env = spark.createDataFrame([("{}", "u1"), ("{}", "u2")], "raw_json string, source_url string")
    batch = snk.with_row_id(env.withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp")))
    assert snk.append_idempotent(spark, batch, target) == {"inserted": 2}
    assert snk.append_idempotent(spark, batch.unionByName(batch), target) == {"inserted": 0}
    assert spark.read.parquet(target).count() == 2
    with pytest.raises(Exception):
        snk.require_not_null(env.withColumn("source_url", F.lit(None).cast("string")),
                             ["source_url"]).collect()


def test_write_if_any(spark):
    target = scratch_path(spark, "t_empty")
    df = spark.range(3)
    assert snk.write_if_any(df.where("id < 0"), lambda d: d.write.parquet(target)) is False
    assert not snk._exists(spark, target)


def test_stream_equals_batch(spark, sf_dir):
    events = fx.read_table(spark, sf_dir, "events")
    landing = scratch_path(spark, "t_landing")
    n = fx.land_weather_deliveries(spark, events, landing)
    store = st.NewestHours(spark, scratch_path(spark, "t_store"))
    store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=n),
                      scratch_path(spark, "t_ckpt")).awaitTermination()
    store.start_days(scratch_path(spark, "t_ckpt")).awaitTermination()
    batch = weather.stg_weather_hourly(fx.weather_envelopes(events))
    a = sorted(tuple(r) for r in store.hourly().collect())
    b = sorted(tuple(r) for r in batch.collect())
    assert a == b and len(a) == events.count()
    d1 = sorted(tuple(r) for r in store.daily().collect())
    d2 = sorted(tuple(r) for r in weather.fct_weather_daily(batch).collect())
    assert d1 == d2


def test_roundtrip_orders(spark, sf_dir):
    """Packing the flat tables and flattening them gives the flat join back."""
    t = lambda n: fx.read_table(spark, sf_dir, n)
    from tidewater.plans import nested
    flat = nested.stg_orders_items(fx.orders_nested(t("orders"), t("lineitem")))
    li = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert flat.count() == li.count()
    assert flat.agg(F.sum("line_amount")).first()[0] == pytest.approx(
        li.agg(F.sum(F.col("l_quantity").cast("bigint") * F.col("l_extendedprice"))).first()[0])


def test_suite_scans_a_model_once(spark):
    """Two unique tests and one row-level test: one scan, right counts."""
    path = scratch_path(spark, "suite_model")
    rows = [(1, "a", None), (1, "b", "x"), (2, "b", "y"), (None, "b", "x"), (None, "c", "z")]
    spark.createDataFrame(rows, "k int, v string, w string").write.parquet(path)
    report = op.run_suite({"m": spark.read.parquet(path)}, [
        op.ColumnTest("m", "k", "unique"), op.ColumnTest("m", "v", "unique"), op.ColumnTest("m", "k", "not_null"),
        op.ColumnTest("m", "w", "accepted_values", ["x", "y"]), op.ColumnTest("m", "v", "not_null")])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert sorted((r.column_name, r.test, r.failures) for r in report.collect()) == sorted(
        [("k", "unique", 2), ("v", "unique", 3), ("k", "not_null", 2), ("w", "accepted_values", 1), ("v", "not_null", 0)])


def test_suite_without_tests_is_empty(spark):
    from tidewater.operators import run_suite
    assert run_suite({}, []).count() == 0


def test_rank_spread_numbers_a_hot_key_in_many_tasks(spark):
    i = F.col("id")
    rows = spark.range(6000).select(F.when(i % 3 == 0, "hot").when(i % 3 == 1, F.concat(F.lit("k"), i % 50)).alias("k"), (i * 7919 % 6007).alias("v"),
                                    F.when(i % 11 != 0, i % 5).alias("w"), F.lit("x").alias("rn0"))
    spread = op.rank_spread(rows, ["k"], "w desc, v", ranges=7)
    want = op.rank_within(rows, ["k"], "w desc, v")
    assert spread.columns == want.columns and spread.exceptAll(want).isEmpty() and spread.count() == 6000
    empty = rows.limit(0)
    assert op.rank_spread(empty, ["k"], "v").collect() == []


def test_rank_spread_splits_a_hot_key(spark):
    """The only key's rows lie in all files, and one task numbers a file's rows."""
    rows = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = op.rank_spread(rows, ["k"], "v", ranges=8)
    sizes = [r["count"] for r in spark.read.parquet(*out.inputFiles()).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20000 / 4
    assert out.where("rn <> v + 1").isEmpty() and out.count() == 20000


def test_tested_write_equals_the_suite(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "id int, v string")
    tests = [op.ColumnTest("m", "id", "not_null"), op.ColumnTest("m", "id", "unique"), op.ColumnTest("m", "v", "accepted_values", ["a", "b"]), op.ColumnTest("other", "x", "unique")]
    path = scratch_path(spark, "tested")
    got = sorted(map(tuple, op.tested_write(rows, "m", tests, path).collect()))
    assert got == sorted(map(tuple, op.run_suite({"m": rows}, tests[:3]).collect()))
    assert [g[3] for g in got] == [1, 2, 1] and spark.read.parquet(path).count() == 4
    assert {r.status for r in op.tested_write(rows.limit(0), "m", tests, path).collect()} == {"pass"}


def test_catalog_view_is_seen_by_a_second_session(spark, sf_dir):
    hourly = weather.stg_weather_hourly(fx.weather_envelopes(fx.read_table(spark, sf_dir, "events")))
    path = scratch_path(spark, "view_hourly")
    name = "hourly_" + path.rsplit("-", 1)[-1]
    snk.as_table(spark, hourly, name, path)
    snk.as_catalog_view(spark, f"daily_{name}", weather.daily_view_sql(name))
    other = spark.newSession()
    got = sorted(map(repr, other.table(f"daily_{name}").collect()))
    assert got == sorted(map(repr, weather.fct_weather_daily(spark.table(name)).collect()))
    # new rows of the table show without a change to the view
    assert other.table(f"daily_{name}").agg(F.sum("hours_count")).first()[0] == hourly.count()


def test_the_view_query_leaves_no_view(spark, sf_dir):
    from tidewater import catalog
    daily = catalog.queries()["view_materialised"](spark, sf_dir)
    assert not [t.name for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("stg_weather_hourly_")]
    events = fx.read_table(spark, sf_dir, "events")
    assert daily.count() == events.select("user_id", F.to_date("ts")).distinct().count()
