"""Weather queries: P-1, P-2 and the operators they are built from."""

from __future__ import annotations

from .. import fixtures
from ..plans import weather
from ..session import configure
from .registry import register

# The flat rows the packed feed must flatten back to (events as hours of a
# location), written directly against ``events``.
# Fixed value: hours per packed weather document (the packer's default).
MAX_HOURS = 2048

HOURS_SQL = rf"""
  SELECT
    'City ' || CAST(user_id AS VARCHAR) AS city,
    'Country ' || CAST(user_id % 25 AS VARCHAR) AS country,
    CAST((user_id % 1200) - 600 AS DOUBLE) / 10.0 AS lat,
    CAST(((user_id // 1200) % 3600) - 1800 AS DOUBLE) / 10.0 AS lon,
    CAST(ts AS DATE) AS day_date,
    CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_epoch,
    CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(38,9)) END AS temp_c,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS humidity,
    event_type AS condition_text,
    event_id % greatest(1, CAST(ceil(count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) / {MAX_HOURS}) AS BIGINT))
      AS chunk
  FROM events
"""

HOURLY_SQL = f"""
WITH h AS ({HOURS_SQL}),
r AS (
  SELECT *,
    make_timestamp(time_epoch * 1000000) AS observed_at,
    'https://api.weather.example/v1/history.json?q=' || CAST(lat AS VARCHAR) || ',' ||
      CAST(lon AS VARCHAR) || '&dt=' || strftime(day_date, '%Y-%m-%d') ||
      CASE WHEN chunk > 0 THEN '&part=' || CAST(chunk AS VARCHAR) ELSE '' END AS source_url,
    CAST(day_date AS TIMESTAMP) + INTERVAL 26 HOUR AS fetched_at,
    md5(CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) || '|' || CAST(time_epoch AS VARCHAR))
      AS weather_hour_id,
    row_number() OVER (PARTITION BY lat, lon, time_epoch
      ORDER BY temp_c DESC NULLS LAST, humidity DESC NULLS LAST, condition_text NULLS LAST,
               city NULLS LAST, country NULLS LAST, day_date NULLS LAST) AS rn
  FROM h
)
SELECT city, country, lat, lon, day_date, time_epoch, observed_at, temp_c, humidity,
       condition_text, source_url, fetched_at, weather_hour_id
FROM r WHERE rn = 1
"""

DAILY_SQL = f"""
WITH hourly AS ({HOURLY_SQL})
SELECT
  CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) || '|' || strftime(CAST(observed_at AS DATE), '%Y-%m-%d')
    AS weather_day_key,
  city, country, lat, lon, CAST(observed_at AS DATE) AS day_utc,
  count(*) AS hours_count,
  round(CAST(avg(temp_c) AS DOUBLE), 6) AS avg_temp_c,
  CAST(min(temp_c) AS DOUBLE) AS min_temp_c,
  CAST(max(temp_c) AS DOUBLE) AS max_temp_c
FROM hourly
GROUP BY 1, 2, 3, 4, 5, 6
"""


def weather_raw(spark, sf_dir):
    configure(spark)
    return fixtures.weather_envelopes(fixtures.read_table(spark, sf_dir, "events"))


@register("weather_hourly", HOURLY_SQL)
def weather_hourly(spark, sf_dir):
    """P-1: packed weather envelopes -> newest hourly rows."""
    return weather.stg_weather_hourly(weather_raw(spark, sf_dir))


@register("weather_daily", DAILY_SQL)
def weather_daily(spark, sf_dir):
    """P-2: daily mart over P-1."""
    return weather.fct_weather_daily(weather.stg_weather_hourly(weather_raw(spark, sf_dir)))
