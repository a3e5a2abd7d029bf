"""P-1/P-2 edge rules on hand-made envelopes."""

from pyspark.sql import functions as F

from tidewater.plans import weather

H = "https://x/v1/history.json?q=1,2&dt=2024-01-01"


def _raw(spark, rows):
    return spark.createDataFrame(rows, "raw_json string, source_url string, fetched_at string") \
        .withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def doc(temp='"1.5"', hours=None, lat="1.0"):
    hours = hours or f'[{{"time_epoch": 3600, "temp_c": {temp}, "humidity": 50, "condition": {{"text": "sun"}}}}]'
    return ('{"location": {"name": "A", "country": "C", "lat": %s, "lon": 2.0}, '
            '"forecast": {"forecastday": [7, {"date": "1970-01-01", "hour": %s}]}}' % (lat, hours))


def test_flatten_rules(spark):
    rows = [
        (doc(), H, "2024-01-02 00:00:00"),                       # kept (newest of two)
        (doc(temp="99"), H, "2024-01-01 23:00:00"),               # older delivery
        (doc(temp="5"), H.replace("history", "forecast"), "2024-01-03 00:00:00"),  # not history
        ("{'location': 1}", H, "2024-01-04 00:00:00"),            # single quotes: unparsable
        ('{"location": {"name": "A"', H, "2024-01-04 00:00:00"),  # truncated
        ('{"location": {"name": "B", "lat": 3.0, "lon": 4.0}, "forecast": {"forecastday": {"date": 1}}}',
         H, "2024-01-04 00:00:00"),                               # forecastday not an array
    ]
    out = weather.stg_weather_hourly(_raw(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.city, r.lat, r.time_epoch, str(r.temp_c), r.humidity, r.condition_text) == \
        ("A", 1.0, 3600, "1.500000000", 50, "sun")
    assert str(r.observed_at) == "1970-01-01 01:00:00"


def test_daily_counts_null_temperatures(spark):
    hours = ('[{"time_epoch": 0, "temp_c": "n/a"}, {"time_epoch": 60, "temp_c": 2}, '
             '{"time_epoch": 120, "temp_c": {"v": 1}}]')
    out = weather.fct_weather_daily(weather.stg_weather_hourly(
        _raw(spark, [(doc(hours=hours), H, "2024-01-02 00:00:00")]))).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.hours_count, r.avg_temp_c, r.min_temp_c, r.max_temp_c) == (3, 2.0, 2.0, 2.0)
    assert r.weather_day_key == "1.0,2.0|1970-01-01"


def test_chunked_documents_match_oracle(spark, sf_dir):
    """With 3 hours per document every (user, day) is split into several
    fetches; each keeps its own row id and the result equals the oracle."""
    from tidewater import fixtures as fx
    from tidewater.catalog import weather as cw
    from tidewater.catalog.compare import compare, duckdb_for
    from tidewater.sinks import tables as snk
    from tidewater.session import scratch_path
    events = fx.read_table(spark, sf_dir, "events")
    env = fx.weather_envelopes(events, max_hours=3)
    sql = cw.HOURLY_SQL.replace(f"/ {cw.MAX_HOURS})", "/ 3)")
    assert "/ 3)" in sql
    con = duckdb_for(sf_dir)
    assert compare(weather.stg_weather_hourly(env), con, sql) is None
    # through the idempotent raw append: no chunk is lost to a shared row id
    target = scratch_path(spark, "chunked_raw")
    snk.append_idempotent(spark, snk.with_row_id(env), target)
    assert compare(weather.stg_weather_hourly(spark.read.parquet(target)), con, sql) is None
