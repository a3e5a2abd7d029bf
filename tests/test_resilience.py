"""Replays, restarts and hot keys."""

import pytest
from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import streaming as st
from tidewater.plans import raw_load, weather
from tidewater.session import scratch_path
from tidewater.sinks import tables


def test_intake_replay_is_idempotent(spark, sf_dir):
    """A run that is restarted from scratch (lost checkpoint) over the same
    landed files adds nothing; a restart with the checkpoint resumes."""
    events = fx.read_table(spark, sf_dir, "events")
    landing = scratch_path(spark, "r_landing")
    n = fx.land_weather_deliveries(spark, events, landing)
    raw = scratch_path(spark, "r_raw")
    ckpt = scratch_path(spark, "r_ckpt")
    st.start_intake(spark, landing, raw, ckpt, max_files_per_trigger=n).awaitTermination()
    first = spark.read.parquet(raw).count()
    st.start_intake(spark, landing, raw, ckpt, max_files_per_trigger=n).awaitTermination()
    st.start_intake(spark, landing, raw, scratch_path(spark, "r_ckpt2")).awaitTermination()
    again = spark.read.parquet(raw)
    assert again.count() == first
    assert again.select("row_id").distinct().count() == first
    expected = fx.weather_envelopes(events).select("source_url", "fetched_at").distinct().count()
    assert first == expected


def test_hot_group_is_split(spark):
    """One (user, day) holding every event is packed into several bounded
    documents and still flattens back to every event."""
    ev = spark.range(5000).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("id").cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("ts"),
        F.lit(7).cast("bigint").alias("user_id"), F.lit("view").alias("event_type"),
        (F.col("id") % 100).cast("double").alias("value"), F.lit('{"k": 1}').alias("props"))
    docs = fx.weather_documents(ev, max_hours=512)
    sizes = [r.n for r in docs.select(F.json_array_length(
        F.get_json_object("doc_new", "$.forecast.forecastday[0].hour")).alias("n")).collect()]
    assert len(sizes) >= 8 and sum(sizes) == 5000 and max(sizes) < 1024
    hourly = weather.stg_weather_hourly(fx.weather_envelopes(ev, max_hours=512))
    assert hourly.count() == 5000


def test_load_keeps_every_chunk_of_a_long_day(spark):
    """5,000 hours of one user-day arrive as three documents and all stay."""
    ev = spark.range(5000).select(F.col("id").alias("event_id"), F.lit(3).cast("bigint").alias("user_id"),
                                  F.timestamp_seconds(F.col("id") * 10 + 1704067200).alias("ts"), F.lit("view").alias("event_type"),
                                  F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props"))
    docs = fx.weather_documents(ev)
    reqs = docs.select(F.lit("1,2").alias("location"), F.date_format("day", "yyyy-MM-dd").alias("date"), F.col("chunk").alias("part"), F.col("doc_new").alias("payload"))
    target = scratch_path(spark, "long_day")
    assert raw_load.load_weather(spark, reqs, target, "2024-02-01 06:00:00")["inserted"] == 3
    assert raw_load.load_weather(spark, reqs, target, "2024-02-01 06:00:00")["inserted"] == 0
    hours = F.json_array_length(F.get_json_object("raw_json", "$.forecast.forecastday[0].hour"))
    assert spark.read.parquet(target).agg(F.sum(hours)).first()[0] == 5000


@pytest.mark.parametrize("rows, problem", [([("k", "a"), ("k", "b")], "different rows share the key"), ([(None, "a")], "NULL in required column")])
def test_append_refuses_ambiguous_keys(spark, rows, problem):
    batch = spark.createDataFrame([(k, "2024-01-01", v) for k, v in rows], "row_id string, fetched_date string, raw_json string")
    with pytest.raises(Exception, match=problem):
        tables.append_idempotent(spark, batch, scratch_path(spark, "ambiguous"))


def test_append_takes_a_repeated_row_once(spark):
    batch = spark.createDataFrame([("k", "2024-01-01", "a"), ("k", "2024-01-01", "a"), ("m", "2024-01-02", "b")], "row_id string, fetched_date string, raw_json string")
    target = scratch_path(spark, "repeat")
    assert [tables.append_idempotent(spark, batch, target)["inserted"] for _ in range(3)] == [2, 0, 0]
