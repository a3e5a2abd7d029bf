"""Request-shaped inputs: ingest parameters, pushed bodies, produced records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (fallback, greeting, json_kind, json_value, now_or, safe_parse,
                         sha256_prefix, utc_stamp, yesterday)

# Defaults of the reference's ingest programs.
DEFAULT_LOCATION = "59.3293,18.0686"
HISTORY_URL = "https://api.weatherapi.com/v1/history.json"
DEFAULT_PERSON = "Student"
PRODUCER_VERSION = "1.0.0"


def source_url(location, date, base: str = HISTORY_URL) -> Column:
    """SRC-12: ``{base}?q={location}&dt={date}`` (no secrets in the key)."""
    return F.concat(F.lit(base), F.lit("?q="), location, F.lit("&dt="), date)


def ingest_plan(requests: DataFrame, default_location: str | None = DEFAULT_LOCATION,
                default_date: str | None = None, as_of=None,
                location_col: str | list = "location", date_col: str | list = "date") -> DataFrame:
    """SRC-11: resolve each request's location (request -> default) and date
    (request -> configured default -> yesterday UTC); ``''`` counts as
    missing (Python ``or``).  A list of columns is tried in order (e.g. the
    JSON body's field, then the query argument).  Adds ``source_url``."""
    as_list = lambda c: [c] if isinstance(c, str) else list(c)
    loc = fallback(*[F.col(c) for c in as_list(location_col)], F.lit(default_location).cast("string"))
    day = fallback(*[F.col(c) for c in as_list(date_col)], F.lit(default_date).cast("string"),
                   yesterday(as_of))
    out = requests.withColumn("resolved_location", loc).withColumn("resolved_date", day)
    return out.withColumn("source_url", source_url(F.col("resolved_location"), F.col("resolved_date")))


def envelope_from_body(bodies: DataFrame, body_col: str = "body", fetched_at=None) -> DataFrame:
    """SRC-13: a pushed JSON body becomes ``(raw_json, source_url,
    fetched_at)``; ``source_url`` is read from the body as text ('' when
    the key is absent, 'None' when it is JSON null), the body is stored whole."""
    v = safe_parse(body_col)
    node = F.try_variant_get(v, "$.source_url", "variant")
    url = (F.when(node.isNull(), F.lit(""))
           .when(json_kind(node) == "VOID", F.lit("None"))
           .otherwise(F.coalesce(json_value(node), F.to_json(node))))
    return bodies.select(F.col(body_col).alias("raw_json"), url.alias("source_url"),
                         now_or(fetched_at).alias("fetched_at"))


def with_source_url(bodies: DataFrame, body_col: str = "body", url_col: str = "source_url") -> DataFrame:
    """SRC-14: set ``source_url`` inside the JSON payload when the payload
    is an object (replacing an existing key); other payloads pass unchanged."""
    v = safe_parse(body_col)
    m = F.try_variant_get(v, "$", "map<string,variant>")
    merged = F.map_concat(F.map_filter(m, lambda k, _: k != F.lit("source_url")),
                          F.create_map(F.lit("source_url"), F.col(url_col).cast("variant")))
    return bodies.withColumn(body_col, F.when(json_kind(v) == "OBJECT", F.to_json(merged))
                             .otherwise(F.col(body_col)))


def produce_records(requests: DataFrame, secret: str, name_col: str = "name",
                    default_name: str = DEFAULT_PERSON, produced_at=None,
                    version: str = PRODUCER_VERSION) -> DataFrame:
    """SRC-15: ``{produced_at, name, message, signature, version}`` per
    request; the name falls back to the default when missing or ''; the
    signature is the first 12 hex digits of SHA-256(name + secret)."""
    person = fallback(F.col(name_col), F.lit(default_name))
    return requests.select(
        utc_stamp(produced_at).alias("produced_at"),
        person.alias("name"),
        greeting(person).alias("message"),
        sha256_prefix(F.concat(person, F.lit(secret))).alias("signature"),
        F.lit(version).alias("version"))
