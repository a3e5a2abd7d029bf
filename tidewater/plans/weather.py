"""Weather: raw envelopes -> hourly staging (newest wins) -> daily mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (NUMERIC, date_of, epoch_to_timestamp, json_query_array, json_value,
                         location_key, md5_hex, safe_cast, strict_cast)
from ..functions.json import parse_shape
from ..operators import deduplicate, group_stats, where_like

HOURLY_COLUMNS = ["city", "country", "lat", "lon", "day_date", "time_epoch", "observed_at",
                  "temp_c", "humidity", "condition_text", "source_url", "fetched_at",
                  "weather_hour_id"]

# Newest delivery first; the remaining columns make the order total so equal
# fetch times never pick an arbitrary row.
HOURLY_ORDER = ["fetched_at desc", "source_url", "temp_c desc", "humidity desc",
                "condition_text", "city", "country", "day_date"]


# The fixed outer shape of a weather document; leaves stay VARIANT.
WEATHER_SHAPE = "location variant, forecast struct<forecastday: array<variant>>"


def flatten_weather(raw: DataFrame) -> DataFrame:
    """P-1 up to the dedup: FLT-1 -> FN-1 -> LAT-3 -> FN-3/6/7/9 -> FN-11.

    Each document is parsed once (``parse_shape``: outer levels typed,
    leaves VARIANT, same NULL rules as SAFE.PARSE_JSON + JSON_QUERY_ARRAY);
    location scalars are read before the unnest so they are not
    re-extracted per hour.
    """
    src = where_like(raw, "source_url", "%history.json%").select(
        parse_shape("raw_json", WEATHER_SHAPE).alias("j"), "source_url", "fetched_at")
    loc = F.col("j.location")
    docs = src.select(
        json_value(loc, "$.name").alias("city"),
        json_value(loc, "$.country").alias("country"),
        strict_cast(json_value(loc, "$.lat"), "double").alias("lat"),
        strict_cast(json_value(loc, "$.lon"), "double").alias("lon"),
        F.col("j.forecast.forecastday").alias("days"),
        "source_url", "fetched_at")
    parents = ["city", "country", "lat", "lon", "source_url", "fetched_at"]
    # not a bare column: Spark would derive a filter from it, which parses
    # every document again
    days = docs.select(*parents, F.explode(F.coalesce("days", F.array().cast("array<variant>"))).alias("day"))
    hours = days.select(*parents, date_of(json_value("day", "$.date")).alias("day_date"),
                        F.explode(json_query_array("day", "$.hour")).alias("hour"))
    epoch = strict_cast(json_value("hour", "$.time_epoch"), "bigint")
    flat = hours.select(
        "city", "country", "lat", "lon", "day_date",
        epoch.alias("time_epoch"),
        epoch_to_timestamp(epoch).alias("observed_at"),
        safe_cast(json_value("hour", "$.temp_c"), NUMERIC).alias("temp_c"),
        safe_cast(json_value("hour", "$.humidity"), "bigint").alias("humidity"),
        json_value("hour", "$.condition.text").alias("condition_text"),
        "source_url", "fetched_at")
    return flat.withColumn("weather_hour_id", weather_hour_id())


def weather_hour_id() -> Column:
    """The key of an hourly row (FN-11)."""
    return md5_hex(location_key("lat", "lon", "time_epoch"))


def dedup_hours(flat: DataFrame) -> DataFrame:
    """WIN-1 + FLT-3 + PRJ-2: newest record per (lat, lon, time_epoch); the
    coordinates are compared as text like the warehouse model does."""
    keys = [F.col("lat").cast("string"), F.col("lon").cast("string"), F.col("time_epoch")]
    return deduplicate(flat, keys, HOURLY_ORDER).select(*HOURLY_COLUMNS)


def stg_weather_hourly(raw: DataFrame) -> DataFrame:
    """P-1: one row per location and hour, newest delivery wins."""
    return dedup_hours(flatten_weather(raw))


def fct_weather_daily(hourly: DataFrame, also: tuple = ()) -> DataFrame:
    """P-2: per location and UTC day: hour count and temperature stats.

    ``count(*)`` counts hours with a NULL temperature, avg/min/max skip them.
    Temperatures leave the mart as DOUBLE; the average is rounded to 6
    decimals so it does not depend on decimal vs. binary summation order.
    ``also`` names columns that are constant per location and day and stay.
    """
    h = hourly.select("city", "country", "lat", "lon",
                      date_of("observed_at").alias("day_utc"), "temp_c", *also)
    h = h.withColumn("weather_day_key", location_key("lat", "lon", "day_utc"))
    g = group_stats(h, ["weather_day_key", "city", "country", "lat", "lon", "day_utc", *also], "temp_c")
    return g.select("weather_day_key", "city", "country", "lat", "lon", "day_utc",
                    F.col("count").alias("hours_count"), F.col("avg").alias("avg_temp_c"),
                    F.col("min").alias("min_temp_c"), F.col("max").alias("max_temp_c"), *also)


def daily_view_sql(hourly: str) -> str:
    """P-2 as the SQL text of a view over the catalog table or view ``hourly``."""
    return f"""
SELECT concat(CAST(lat AS STRING), ',', CAST(lon AS STRING), '|', CAST(day_utc AS STRING)) AS weather_day_key,
       city, country, lat, lon, day_utc, count(*) AS hours_count, round(CAST(avg(temp_c) AS DOUBLE), 6) AS avg_temp_c,
       CAST(min(temp_c) AS DOUBLE) AS min_temp_c, CAST(max(temp_c) AS DOUBLE) AS max_temp_c
FROM (SELECT city, country, lat, lon, to_date(observed_at) AS day_utc, temp_c FROM {hourly})
GROUP BY city, country, lat, lon, day_utc"""
