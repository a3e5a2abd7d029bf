"""Plan-shape tests: the scale properties are checked on the physical plan."""

import contextlib
import io

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater.plans import weather
from tidewater.session import scratch_path
from tidewater.sinks import tables as snk


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _raw(spark, sf_dir):
    path = scratch_path(spark, "plan_raw")
    fx.weather_envelopes(fx.read_table(spark, sf_dir, "events")).write.parquet(path)
    return spark.read.parquet(path)


def test_weather_scan_pushdown_and_partial_dedup(spark, sf_dir):
    p = plan(weather.fct_weather_daily(weather.stg_weather_hourly(_raw(spark, sf_dir))))
    assert "StringContains(source_url,history.json)" in p            # filter reaches the scan
    assert "ReadSchema: struct<raw_json:string,source_url:string,fetched_at:timestamp>" in p
    tree = p.split("\n\n")[0]
    # one row per key and map task before the shuffle, the final limit after it
    lines = [ln.strip("+-: ") for ln in tree.splitlines()]
    wgl = [i for i, ln in enumerate(lines) if ln.startswith("WindowGroupLimit")]
    exch = [i for i, ln in enumerate(lines) if ln.startswith("Exchange")]
    assert len(wgl) == 2 and any(wgl[0] < e < wgl[1] for e in exch)
    assert tree.count("HashAggregate") == 2                           # partial + final


def test_append_reads_only_touched_days(spark):
    target = scratch_path(spark, "plan_append")
    env = spark.createDataFrame([("{}", f"u{i}", f"2024-01-{i:02d} 00:00:00") for i in range(1, 11)],
                                "raw_json string, source_url string, fetched_at string")
    batch = snk.with_row_id(env.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")))
    snk.append_idempotent(spark, batch, target)
    one = batch.where(F.col("source_url") == "u3")
    p = plan(snk.key_exceptions(one, snk.stored_rows(spark, target, one), "row_id", "fetched_date"))
    assert "PartitionFilters: [isnotnull(fetched_date" in p or "PartitionFilters: [fetched_date" in p
    part_line = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")][0]
    assert "2024-01-03" in part_line and "2024-01-04" not in part_line


def test_partitioned_mart_is_pruned(spark, sf_dir):
    daily = weather.fct_weather_daily(weather.stg_weather_hourly(_raw(spark, sf_dir)))
    t = snk.as_partitioned_table(spark, daily, scratch_path(spark, "plan_mart"))
    p = plan(t.where(F.col("day_utc") == F.lit("2024-01-15").cast("date")))
    assert "PartitionFilters: [isnotnull(day_utc" in p and "2024-01-15" in p


def test_single_column_scan(spark, sf_dir):
    from tidewater.sources.tables import single_column
    p = plan(single_column(fx.read_table(spark, sf_dir, "lineitem"), "l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in p


def test_partitioned_write_avoids_tasks_times_days_files(spark):
    import glob as g
    path = scratch_path(spark, "plan_files")
    df = spark.range(0, 40000, numPartitions=8).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("day_utc"),
        (F.col("id") % 97).cast("string").alias("city"), F.col("id"))
    df = df.repartition(8, "id")                      # every task holds every day
    snk.write_partitioned(df, path, "day_utc", ("city",))
    local = path[len("file:"):] if path.startswith("file:") else path
    files = g.glob(f"{local}/day_utc=*/*.parquet")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert len(files) <= int(parts) + 10 < 8 * 10
    assert spark.read.parquet(path).count() == 40000


def test_shuffle_sizing_from_input(spark, sf_dir):
    from tidewater.session import input_bytes, size_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n_small = size_for_input(spark, input_bytes(spark, f"{sf_dir}/events.parquet"))
        assert n_small == 2 * spark.sparkContext.defaultParallelism       # tiny input: floor
        n_big = size_for_input(spark, 100 << 40)                            # 100 TB on disk
        assert n_big == -(-(100 << 40) * 4 // (256 << 20))
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n_big)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
