"""Newest-wins and daily windows on streaming state: always the batch model."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import streaming as st
from tidewater.plans import weather
from tidewater.session import scratch_path
from tidewater.streaming.newest import newest_hours, order_text

ENVELOPE = "raw_json string, source_url string, fetched_at timestamp"


def _document(hours, lat=1.0, city="A"):
    return json.dumps({"location": {"name": city, "lat": lat, "lon": 2.0}, "forecast": {"forecastday": [{"date": "2024-01-01", "hour": [
        {"temp_c": t} | ({"time_epoch": e} if e is not None else {}) for e, t in hours]}]}})


def _land(spark, landing, rows):
    df = spark.createDataFrame(rows, "raw_json string, source_url string, fetched_at string")
    df.withColumn("fetched_at", F.to_timestamp("fetched_at")).coalesce(1).write.mode("append").parquet(landing)


def _rows(df):
    return sorted(map(repr, df.collect()))


def _check(spark, store, landing):
    hourly = weather.stg_weather_hourly(spark.read.schema(ENVELOPE).parquet(landing))
    assert _rows(store.hourly()) == _rows(hourly)
    assert _rows(store.daily()) == _rows(weather.fct_weather_daily(hourly))


def _run(spark, store, landing, hours, days):
    store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=1), hours).awaitTermination()
    store.start_days(days).awaitTermination()


DAY = 1704067200
DELIVERIES = [
    [(_document([(DAY, 5), (DAY + 3600, 6), (None, 1)]), "u/history.json?a", "2024-01-03 00:00:00")],
    [(_document([(DAY, 99), (DAY + 7200, 7)]), "u/history.json?a", "2024-01-02 00:00:00"), (_document([(DAY, 2)], lat=None), "u/history.json?n", "2024-01-02 00:00:00")],
    [(_document([(DAY + 90000, 1)]), "u/history.json?b", "2024-01-03 00:00:00"), (_document([(DAY, 5), (DAY, 8)], city="B"), "u/history.json?a", "2024-01-03 00:00:00")],
    [(_document([(DAY + 3600, "n/a"), (None, 4)], city="C"), "u/history.json?a", "2024-01-05 00:00:00"), (_document([(DAY, 3)])[:-1], "u/history.json?x", "2024-01-09 00:00:00")],
    [(_document([(DAY + 3600, -2)]), "u/history.json?late", "2023-12-31 00:00:00")],
]


def test_streams_equal_the_batch_model(spark):
    """Out-of-order deliveries with restarts in between, a lost checkpoint of
    each stream, removed landed files, and compaction."""
    landing, store = scratch_path(spark, "s_land"), st.NewestHours(spark, scratch_path(spark, "s_store"))
    assert store.hourly().count() == 0 and store.daily().count() == 0
    hours, days = scratch_path(spark, "s_ckpt"), scratch_path(spark, "s_ckpt")
    for rows in DELIVERIES:
        _land(spark, landing, rows)
        _run(spark, store, landing, hours, days)
        _check(spark, store, landing)
    _run(spark, store, landing, scratch_path(spark, "s_ckpt"), days)
    _check(spark, store, landing)
    _run(spark, store, landing, hours, scratch_path(spark, "s_ckpt"))
    _check(spark, store, landing)
    assert store.compact(files=1) > 0
    _check(spark, store, landing)
    assert store.compact(files=8) == 0
    # A fresh start that only sees a stale delivery must not bring it back.
    again = scratch_path(spark, "s_land")
    _land(spark, again, DELIVERIES[1])
    _run(spark, store, again, scratch_path(spark, "s_ckpt"), days)
    _check(spark, store, landing)
    _run(spark, store, landing, hours, scratch_path(spark, "s_ckpt"))
    _check(spark, store, landing)


def test_a_replayed_or_half_written_batch_changes_nothing(spark):
    landing, store = scratch_path(spark, "h_land"), st.NewestHours(spark, scratch_path(spark, "h_store"))
    for rows in DELIVERIES:
        _land(spark, landing, rows)
    _run(spark, store, landing, scratch_path(spark, "h_ckpt"), scratch_path(spark, "h_ckpt"))
    flat = weather.flatten_weather(spark.read.schema(ENVELOPE).parquet(landing))
    store.append_hours(newest_hours(flat))
    store.append_hours(flat.where("temp_c > 5"))  # any part of what was delivered
    store.rebuild_days()
    _check(spark, store, landing)


def test_late_hours_behind_the_watermark_come_back_by_a_rebuild(spark):
    landing, store = scratch_path(spark, "w_land"), st.NewestHours(spark, scratch_path(spark, "w_store"))
    hours, days = scratch_path(spark, "w_ckpt"), scratch_path(spark, "w_ckpt")

    def deliver(epoch, temp):
        _land(spark, landing, [(_document([(epoch, temp)]), "u/history.json?a", "2024-03-01 00:00:00")])
        store.start_hours(st.read_envelopes(spark, landing), hours).awaitTermination()
        store.start_days(days, lateness="2 days").awaitTermination()
    deliver(DAY, 1)
    deliver(DAY + 86400, 2)
    deliver(DAY + 3600, 3)              # late, within two days
    _check(spark, store, landing)
    deliver(DAY + 40 * 86400, 4)
    deliver(DAY + 41 * 86400, 4)
    deliver(DAY + 7200, 5)              # later than the watermark
    assert store.daily().agg(F.sum("hours_count")).first()[0] == 5
    store.rebuild_days()
    _check(spark, store, landing)


def test_order_text_ranks_like_the_batch_order(spark):
    rnd = random.Random(0)
    pick = lambda *xs: rnd.choice([None, *xs])
    rows = [(pick("a", "ab", "", "é", "B"), pick("x", "xy"), 1.0, 2.0, pick("2024-01-01", "1969-12-31"), rnd.choice([None, 1, 2]), pick("1.5", "-1.5", "-20", "0", "300.000000001"),
             pick(0, -1, 70, 2 ** 40), pick("sun", "sunny"), pick("u", "uv"), pick("2024-01-01 00:00:00", "1950-01-01 00:00:00.5")) for _ in range(4000)]
    df = spark.createDataFrame(rows, "city string, country string, lat double, lon double, day string, time_epoch long, temp string, humidity long, condition_text string, source_url string, at string")
    df = df.select("city", "country", "lat", "lon", F.to_date("day").alias("day_date"), "time_epoch", F.timestamp_seconds("time_epoch").alias("observed_at"),
                   F.col("temp").cast("decimal(38,9)").alias("temp_c"), "humidity", "condition_text", "source_url", F.to_timestamp("at").alias("fetched_at"), F.lit("k").alias("weather_hour_id"))
    assert _rows(newest_hours(df)) == _rows(weather.dedup_hours(df))
    some = df.sample(0.1, seed=1)
    for i in range(20):
        part = some.where(F.abs(F.hash(F.struct(*some.columns), F.lit(i))) % 7 == 0).withColumn("time_epoch", F.lit(1).cast("long"))
        assert _rows(newest_hours(part)) == _rows(weather.dedup_hours(part))
    assert df.select(order_text().alias("t")).where("t is null").count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_whole_feed_in_any_batching(spark, sf_dir, batches):
    landing, store = scratch_path(spark, "f_land"), st.NewestHours(spark, scratch_path(spark, "f_store"))
    fx.weather_envelopes(fx.read_table(spark, sf_dir, "events")).repartition(3, "fetched_at").write.parquet(landing)
    store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=4 - batches), scratch_path(spark, "f_ckpt")).awaitTermination()
    store.start_days(scratch_path(spark, "f_ckpt")).awaitTermination()
    _check(spark, store, landing)


def test_windows_of_a_day_share_state_rows(spark):
    """Rows of 300 locations, told apart by every column of the order, in two
    batches; state rows follow the days and buckets, not the windows."""
    rnd = random.Random(3)
    pick = lambda *xs: rnd.choice([None, *xs])
    rows = [(pick("a", "ab"), pick("x", "xy"), rnd.choice([None, float(i)]), 2.0, pick("2024-01-01", "1969-12-31"), DAY + 90000 * (i % 2), pick("0", "-1.5", "-20", "100", "20"),
             pick(0, -1, 70), pick("sun", "sunny"), pick("u", "uv"), pick("2024-01-03 00:00:00", "2024-01-02 00:00:00.5")) for i in range(300) for _ in range(6)]
    df = spark.createDataFrame(rows, "city string, country string, lat double, lon double, day string, time_epoch long, temp string, humidity long, condition_text string, source_url string, at string")
    df = df.select("city", "country", "lat", "lon", F.to_date("day").alias("day_date"), "time_epoch", F.timestamp_seconds("time_epoch").alias("observed_at"),
                   F.col("temp").cast("decimal(38,9)").alias("temp_c"), "humidity", "condition_text", "source_url", F.to_timestamp("at").alias("fetched_at"), F.lit("k").alias("weather_hour_id"))
    store, ckpt = st.NewestHours(spark, scratch_path(spark, "b_store")), scratch_path(spark, "b_ckpt")
    half = F.pmod(F.hash(*df.columns), F.lit(2))
    for i in range(2):
        store.append_hours(df.where(half == i))
        days = store.start_days(ckpt)
        days.awaitTermination()
        seen = weather.dedup_hours(df.where(half <= i))
        assert _rows(store.daily()) == _rows(weather.fct_weather_daily(seen))
    state = max(p["stateOperators"][0]["numRowsTotal"] for p in days.recentProgress)
    assert 2 <= state <= 2 * 8 and seen.count() > 250


def _random_document(rnd):
    pick = lambda *xs: rnd.choice([None, *xs])
    hours = [{"time_epoch": pick(DAY, DAY + 3600, DAY + 90000, -1), "temp_c": pick(0, "n/a", "-1.5", -20, "20", 3e-9, "12345678901234567890.123456789"),
              "humidity": pick(0, -1, 2 ** 60, 2 ** 60 + 1), "condition": {"text": pick("", "sun", "é", "\U0001F600")}} for _ in range(6)]
    return json.dumps({"location": {"name": pick("a", "ab"), "country": pick("x", "xy"), "lat": pick(-0.0, 0.0, 1.5), "lon": pick(2.0, 1e-5)},
                       "forecast": {"forecastday": [{"date": pick("2024-01-01", "1969-12-31"), "hour": hours}]}})


def test_hours_of_a_day_share_state_rows(spark):
    """Rows told apart by every column of the order, NULLs among them, in three
    batches: state rows follow the days and buckets, not the hours."""
    rnd = random.Random(5)
    landing, store, ckpt = scratch_path(spark, "k_land"), st.NewestHours(spark, scratch_path(spark, "k_store")), scratch_path(spark, "k_ckpt")
    url = lambda: rnd.choice(["u/history.json?a", "u/history.json?ab"])
    at = lambda: rnd.choice([None, "2024-01-03 00:00:00", "1950-01-01 00:00:00.5"])
    for _ in range(3):
        _land(spark, landing, [(_random_document(rnd), url(), at()) for _ in range(150)])
        hours = store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=1), ckpt, buckets=3)
        hours.awaitTermination()
        batch = weather.stg_weather_hourly(spark.read.schema(ENVELOPE).parquet(landing))
        assert _rows(store.hourly()) == _rows(batch)
    # three days, and the hours without a time
    assert hours.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4 * 3 < batch.count()


def test_copies_that_are_not_newer_are_not_logged(spark):
    landing, store, ckpt = scratch_path(spark, "n_land"), st.NewestHours(spark, scratch_path(spark, "n_store")), scratch_path(spark, "n_ckpt")
    newest = (_document([(DAY + i, 5) for i in range(100)]), "u/history.json?a", "2024-01-03 00:00:00")
    stale = (_document([(DAY + i, 9) for i in range(101)]), "u/history.json?a", "2024-01-02 00:00:00")
    for rows in ([newest], [stale], [newest]):
        _land(spark, landing, rows)
        store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=1), ckpt).awaitTermination()
    assert spark.read.parquet(store.hours_log).count() == 101
    assert _rows(store.hourly()) == _rows(weather.stg_weather_hourly(spark.read.schema(ENVELOPE).parquet(landing)))


def test_an_hour_of_many_rows_and_a_bucket_of_many_hours(spark):
    """More rows of one hour, and more hours of one bucket, than a frame holds."""
    landing, store = scratch_path(spark, "m_land"), st.NewestHours(spark, scratch_path(spark, "m_store"))
    hours = [(DAY + i, i) for i in range(12_000)] + [(DAY, -i) for i in range(12_000)]
    _land(spark, landing, [(_document(hours), "u/history.json?a", "2024-01-03 00:00:00")])
    store.start_hours(st.read_envelopes(spark, landing), scratch_path(spark, "m_ckpt"), buckets=1).awaitTermination()
    got = store.hourly()
    assert got.count() == 12_000 and got.agg(F.sum("temp_c")).first()[0] == sum(range(12_000))


def test_the_flatten_parses_a_document_once(spark, sf_dir):
    raw = fx.weather_envelopes(fx.read_table(spark, sf_dir, "events"))
    stored = scratch_path(spark, "p_raw")
    raw.write.parquet(stored)
    plan = weather.flatten_weather(spark.read.parquet(stored))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("from_json" in line for line in plan.splitlines() if "Filter" in line)
    odd = [(None,), ('{"forecast": null}',), ('{"forecast": {"forecastday": []}}',), ('{"forecast": {"forecastday": [null]}}',), ("{",)]
    rows = spark.createDataFrame(odd, "raw_json string").selectExpr("raw_json", "'u/history.json' source_url", "timestamp'2024-01-03' fetched_at")
    assert weather.flatten_weather(rows).count() == 0
