"""Sources and sinks: landing files, envelopes, appends, tables, records."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import basename, json_query_array, json_value, safe_parse
from ..plans import messages, raw_load, weather
from ..session import configure, ensure_local_dir, scratch_path
from ..sinks import tables as snk
from ..sources import files, requests
from ..sources.tables import single_column, source
from .registry import register
from .weather import DAILY_SQL

FETCHED_AT = "2024-02-01 06:00:00"
SECRET = "s3cr3t"


def _t(spark, sf_dir, name):
    configure(spark)
    return fx.read_table(spark, sf_dir, name)


def _landing(spark, sf_dir):
    root = ensure_local_dir(scratch_path(spark, "landing"))
    fx.write_documents(spark, fx.nation_documents(_t(spark, sf_dir, "nation"),
                                                  _t(spark, sf_dir, "region")), root)
    return root


NATION_DOCS_SQL = """
  SELECT 'nations_' || r_name || '.json' AS name,
         to_json(list(struct_pack(n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey)
                      ORDER BY n_nationkey))::VARCHAR AS text
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
  UNION ALL
  SELECT 'nation_' || CAST(n_nationkey AS VARCHAR) || '.json',
         to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey))::VARCHAR
  FROM nation
  UNION ALL
  SELECT 'broken.json', '{"n_nationkey": 1, "n_name":' FROM region WHERE r_regionkey = 0
"""


@register("scan_json_files", f"""
WITH d AS ({NATION_DOCS_SQL})
SELECT name AS file_name, text AS raw_json, TIMESTAMP '{FETCHED_AT}' AS fetched_at FROM d""")
def scan_json_files(spark, sf_dir):
    """SRC-1: landing folder -> one envelope per file."""
    env = files.scan_json_files(spark, _landing(spark, sf_dir) + "/*.json", FETCHED_AT)
    return env.select(basename("source").alias("file_name"), "raw_json", "fetched_at")


@register("split_valid_documents", f"""
WITH d AS ({NATION_DOCS_SQL})
SELECT name AS file_name, name <> 'broken.json' AS valid FROM d""")
def split_valid_documents(spark, sf_dir):
    """SRC-2: good files vs quarantined bad files."""
    env = files.scan_json_files(spark, _landing(spark, sf_dir) + "/*.json", FETCHED_AT)
    good, bad = files.split_valid(env)
    return (good.select(basename("source").alias("file_name"), F.lit(True).alias("valid"))
            .unionByName(bad.select(basename("source").alias("file_name"), F.lit(False).alias("valid"))))


@register("route_by_basename", f"""
WITH d AS ({NATION_DOCS_SQL})
SELECT name AS file_name, 'raw_' || replace(name, '.json', '') AS table_name FROM d""")
def route_by_basename(spark, sf_dir):
    """SRC-3 + FN-23: target table per file."""
    env = files.scan_json_files(spark, _landing(spark, sf_dir) + "/*.json", FETCHED_AT)
    return env.select(basename("source").alias("file_name"), files.table_for("source").alias("table_name"))


@register("raw_load", f"""
WITH d AS ({NATION_DOCS_SQL})
SELECT 'raw_' || replace(name, '.json', '') AS table_name, text AS raw_json,
       TIMESTAMP '{FETCHED_AT}' AS fetched_at
FROM d WHERE name <> 'broken.json'""")
def raw_load_query(spark, sf_dir):
    """P-14: landing files loaded twice (a retry) -> each good file once."""
    glob = _landing(spark, sf_dir) + "/*.json"
    target = scratch_path(spark, "raw_files")
    raw_load.load_raw_files(spark, glob, target, FETCHED_AT)
    raw_load.load_raw_files(spark, glob, target, FETCHED_AT)
    return spark.read.parquet(target).select("table_name", "raw_json", "fetched_at")


@register("raw_load_routed", f"""
WITH d AS ({NATION_DOCS_SQL})
SELECT CASE WHEN name = 'broken.json' THEN 'quarantine' ELSE 'raw_' || regexp_replace(lower(replace(name, '.json', '')), '[^a-z0-9_]', '_', 'g') END AS table_name,
       name AS file_name, text AS raw_json, TIMESTAMP '{FETCHED_AT}' AS fetched_at,
       (SELECT count(*) FROM d WHERE name <> 'broken.json') AS inserted,
       (SELECT count(*) FROM d WHERE name = 'broken.json') AS skipped, 0 AS inserted_by_retry
FROM d""")
def raw_load_routed(spark, sf_dir):
    """P-14 + SRC-3 + SNK-4: files to their catalog tables and the quarantine
    by one write, twice; rows are read back table by table."""
    root = scratch_path(spark, "routed")
    db = "tw_" + root.rsplit("-", 1)[-1]
    glob = _landing(spark, sf_dir) + "/*.json"
    first = raw_load.load_routed(spark, glob, root, db, FETCHED_AT)
    retry = raw_load.load_routed(spark, glob, root, db, FETCHED_AT)
    names = sorted(t.name for t in spark.catalog.listTables(db))
    out = None
    for name in names:
        rows = spark.table(f"{db}.`{name}`").select(F.lit(name).alias("table_name"), basename("source").alias("file_name"), "raw_json", "fetched_at")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumns({"inserted": F.lit(first["inserted"]).cast("bigint"), "skipped": F.lit(first["skipped"]).cast("bigint"),
                            "inserted_by_retry": F.lit(retry["inserted"]).cast("int")})


@register("append_bucketed", """
SELECT page_id, 'https://api.weather.example/v1/history.json?q=' || page_id AS source_url, url,
       CAST(TIMESTAMP '2024-02-01 06:00:00' + to_days(CAST(page_id % 3 AS INTEGER)) AS TIMESTAMP) AS fetched_at,
       (SELECT count(*) FROM pages) AS inserted, 0 AS inserted_by_retry
FROM pages""")
def append_bucketed(spark, sf_dir):
    """SNK-2 into a table bucketed by row id: three fetch days, delivered
    twice, the second time with every row repeated."""
    p = _t(spark, sf_dir, "pages")
    at = F.lit(FETCHED_AT).cast("timestamp") + F.make_interval(days=(F.col("page_id") % 3).cast("int"))
    batch = snk.with_row_id(p.select(F.to_json(F.struct("page_id", "url")).alias("raw_json"), at.alias("fetched_at"),
                                     F.concat(F.lit("https://api.weather.example/v1/history.json?q="), F.col("page_id").cast("string")).alias("source_url")))
    path = scratch_path(spark, "raw_bucketed")
    name = "raw_bucketed_" + path.rsplit("-", 1)[-1]
    snk.ensure_raw_table(spark, name, path, buckets=8)
    first = snk.append_bucketed(spark, batch, name)["inserted"]
    retry = snk.append_bucketed(spark, batch.unionByName(batch), name)["inserted"]
    doc = safe_parse("raw_json")
    return spark.table(name).select(json_value(doc, "$.page_id").cast("bigint").alias("page_id"), "source_url", json_value(doc, "$.url").alias("url"), "fetched_at",
                                    F.lit(first).cast("bigint").alias("inserted"), F.lit(retry).cast("int").alias("inserted_by_retry"))


def _nation_envelopes(spark, sf_dir, fetched_at=FETCHED_AT):
    n = _t(spark, sf_dir, "nation")
    payload = n.select(F.struct("n_nationkey", "n_name", "n_regionkey").alias("p"),
                       F.concat(F.lit("https://api.weather.example/v1/history.json?q="),
                                F.col("n_name")).alias("url"))
    return snk.with_row_id(snk.to_envelope(payload, "p", "url", fetched_at))


NATION_ENVELOPE_SQL = f"""
  SELECT to_json(struct_pack(n_nationkey := n_nationkey, n_name := n_name, n_regionkey := n_regionkey))::VARCHAR AS raw_json,
         'https://api.weather.example/v1/history.json?q=' || n_name AS source_url,
         TIMESTAMP '{FETCHED_AT}' AS fetched_at
  FROM nation
"""


@register("append_idempotent", f"SELECT * FROM ({NATION_ENVELOPE_SQL})")
def append_idempotent(spark, sf_dir):
    """SNK-1 + SNK-2: the same envelopes delivered twice land once."""
    target = scratch_path(spark, "raw_weather")
    batch = _nation_envelopes(spark, sf_dir)
    snk.append_idempotent(spark, batch, target)
    snk.append_idempotent(spark, batch.unionByName(batch), target)
    return spark.read.parquet(target).select("raw_json", "source_url", "fetched_at")


@register("append_plain", f"SELECT * FROM ({NATION_ENVELOPE_SQL}) UNION ALL SELECT * FROM ({NATION_ENVELOPE_SQL})")
def append_plain(spark, sf_dir):
    """SNK-3: a plain append re-run duplicates every row."""
    target = scratch_path(spark, "raw_plain")
    batch = _nation_envelopes(spark, sf_dir).select("raw_json", "source_url", "fetched_at")
    snk.append_plain(batch, target)
    snk.append_plain(batch, target)
    return spark.read.parquet(target)


@register("load_summary", """
SELECT 1 AS attempt, count(*) AS inserted FROM nation
UNION ALL SELECT 2 AS attempt, 0 AS inserted FROM (SELECT 1) t""")
def load_summary(spark, sf_dir):
    """SNK-10: inserted-row counts of a load and of its retry."""
    target = scratch_path(spark, "raw_summary")
    batch = _nation_envelopes(spark, sf_dir)
    first = snk.append_idempotent(spark, batch, target)["inserted"]
    second = snk.append_idempotent(spark, batch, target)["inserted"]
    return spark.createDataFrame([(1, first), (2, second)], "attempt int, inserted bigint")


@register("ensure_table_not_null", """
SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def ensure_table_not_null(spark, sf_dir):
    """SNK-4 + SNK-5: database and REQUIRED-column table created if absent,
    rows checked for NULLs before the insert."""
    base = scratch_path(spark, "db")
    db = "tw_" + base.rsplit("-", 1)[-1]
    snk.ensure_database(spark, db, base)
    name = f"{db}.nations"
    ddl = "n_nationkey INT NOT NULL, n_name STRING NOT NULL, n_regionkey INT NOT NULL"
    snk.ensure_table(spark, name, ddl, base + "/nations")
    snk.ensure_table(spark, name, ddl, base + "/nations")   # second call is a no-op
    rows = snk.require_not_null(_t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                                ["n_nationkey", "n_name", "n_regionkey"])
    rows.write.insertInto(name)
    return spark.table(name)


@register("skip_empty_write", "SELECT n_nationkey, n_name FROM nation")
def skip_empty_write(spark, sf_dir):
    """SNK-11: an empty frame writes nothing (no table appears); a non-empty
    one is written."""
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    empty_target, target = scratch_path(spark, "empty"), scratch_path(spark, "nonempty")
    wrote_empty = snk.write_if_any(n.where(F.col("n_nationkey") < 0), lambda d: d.write.parquet(empty_target))
    wrote = snk.write_if_any(n, lambda d: d.write.parquet(target))
    assert not wrote_empty and wrote and not snk._exists(spark, empty_target)
    return spark.read.parquet(target)


@register("view_materialised", DAILY_SQL)
def view_materialised(spark, sf_dir):
    """SNK-6: the hourly staging as a view, the mart read through it.  The
    view leaves the session once the mart's plan has taken it up."""
    raw = fx.weather_envelopes(_t(spark, sf_dir, "events"))
    name = "stg_weather_hourly_" + scratch_path(spark, "view").rsplit("-", 1)[-1]   # unique per run
    snk.as_view(weather.stg_weather_hourly(raw), name)
    daily = weather.fct_weather_daily(spark.table(name))
    spark.catalog.dropTempView(name)
    return daily


@register("view_catalog", DAILY_SQL)
def view_catalog(spark, sf_dir):
    """SNK-6: hourly staging as a table, the mart as a catalog view on it."""
    raw = fx.weather_envelopes(_t(spark, sf_dir, "events"))
    path = scratch_path(spark, "stg_weather_hourly")
    run = path.rsplit("-", 1)[-1]   # names unique per run
    snk.as_table(spark, weather.stg_weather_hourly(raw), f"stg_weather_hourly_{run}", path)
    return snk.as_catalog_view(spark, f"fct_weather_daily_view_{run}", weather.daily_view_sql(f"stg_weather_hourly_{run}"))


@register("table_materialised", DAILY_SQL)
def table_materialised(spark, sf_dir):
    """SNK-7: the mart rebuilt as a table (overwrite) and read back."""
    raw = fx.weather_envelopes(_t(spark, sf_dir, "events"))
    path = scratch_path(spark, "fct_weather_daily")
    name = "fct_weather_daily_" + path.rsplit("-", 1)[-1]
    daily = weather.fct_weather_daily(weather.stg_weather_hourly(raw))
    snk.as_table(spark, daily, name, path)
    return snk.as_table(spark, daily, name, path)  # full rebuild is repeatable


@register("table_partitioned", DAILY_SQL)
def table_partitioned(spark, sf_dir):
    """SNK-8: day-partitioned, city-clustered mart, read back whole."""
    raw = fx.weather_envelopes(_t(spark, sf_dir, "events"))
    path = scratch_path(spark, "fct_weather_daily_part")
    daily = weather.fct_weather_daily(weather.stg_weather_hourly(raw))
    return snk.as_partitioned_table(spark, daily, path).select(*daily.columns)


@register("source_nested_scan", """
SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS order_id, count(l_orderkey) AS n_items
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def source_nested_scan(spark, sf_dir):
    """SRC-5 + SRC-7 + SNK-7: nested orders stored as parquet, read back as a
    declared source; only ``items`` sizes are needed."""
    root = scratch_path(spark, "sources")
    fx.orders_nested(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem")) \
        .write.mode("overwrite").parquet(f"{root}/orders")
    o = source(spark, "orders", root)
    return o.groupBy("order_id").agg(F.sum(F.size("items")).cast("bigint").alias("n_items"))


@register("select_single_column", "SELECT l_orderkey FROM lineitem")
def select_single_column(spark, sf_dir):
    """SRC-9: one-column read (ReadSchema holds only that column)."""
    return single_column(_t(spark, sf_dir, "lineitem"), "l_orderkey")


# ------------------------------------------------------------- requests

AS_OF = "2024-03-10 12:00:00"


def _requests(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    loc = (F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit(""))
           .otherwise(F.concat(F.lit("loc-"), F.col("n_name"))))
    day = (F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit(""))
           .otherwise(F.format_string("2024-01-%02d", k + 1)))
    return n.select("n_nationkey", loc.alias("location"), day.alias("date"))


@register("ingest_plan", """
WITH r AS (
  SELECT n_nationkey,
    CASE WHEN n_nationkey % 4 IN (0, 1) THEN '59.3293,18.0686' ELSE 'loc-' || n_name END AS resolved_location,
    CASE WHEN n_nationkey % 3 IN (0, 1) THEN '2024-03-09' ELSE printf('2024-01-%02d', n_nationkey + 1) END AS resolved_date
  FROM nation)
SELECT n_nationkey, resolved_location, resolved_date,
  'https://api.weatherapi.com/v1/history.json?q=' || resolved_location || '&dt=' || resolved_date AS source_url
FROM r""")
def ingest_plan_query(spark, sf_dir):
    """SRC-11/12 + FN-22/25: parameters fall back request -> default ->
    yesterday ('' counts as missing)."""
    plan = requests.ingest_plan(_requests(spark, sf_dir), as_of=AS_OF)
    return plan.select("n_nationkey", "resolved_location", "resolved_date", "source_url")


def _names(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.lit("")).otherwise(F.col("c_name"))
    return c.select("c_custkey", name.alias("name"))


PRODUCED_SQL = f"""
  SELECT c_custkey,
    CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN 'Student' ELSE c_name END AS name
  FROM customer
"""


@register("produce_records", f"""
WITH p AS ({PRODUCED_SQL})
SELECT '2024-02-01T06:00:00+00:00' AS produced_at, name, 'Hello, ' || name || '!' AS message,
       substr(sha256(name || '{SECRET}'), 1, 12) AS signature, '1.0.0' AS version
FROM p""")
def produce_records(spark, sf_dir):
    """SRC-15 + FN-19/20/21: signed greeting records."""
    return messages.produce(_names(spark, sf_dir), SECRET, produced_at=FETCHED_AT)


@register("write_records", f"""
WITH p AS ({PRODUCED_SQL})
SELECT 'exercise/20240201T060000Z_' || name || '.json' AS dest,
  json_object('produced_at', '2024-02-01T06:00:00+00:00', 'name', name, 'message', 'Hello, ' || name || '!',
              'signature', substr(sha256(name || '{SECRET}'), 1, 12), 'version', '1.0.0')::VARCHAR AS payload
FROM p""")
def write_records(spark, sf_dir):
    """P-13 + SNK-9: records written as JSON lines keyed by object name."""
    root = scratch_path(spark, "records")
    messages.produce_and_write(_names(spark, sf_dir), SECRET, root, "exercise/", FETCHED_AT)
    return spark.read.schema("dest string, payload string").json(root).select("dest", "payload")


def _bodies(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    k = F.col("page_id")
    url = F.when(k % 3 == 1, F.col("url"))
    body_obj = F.to_json(F.struct(k.alias("page_id"), url.alias("source_url")),
                         {"ignoreNullFields": "false"})
    body = (F.when(k % 3 == 0, F.to_json(F.struct(k.alias("page_id"))))
            .otherwise(body_obj))
    return p.select("page_id", body.alias("body"))


@register("envelope_from_body", f"""
SELECT CASE WHEN page_id % 3 = 0 THEN json_object('page_id', page_id)::VARCHAR
            ELSE json_object('page_id', page_id, 'source_url', CASE WHEN page_id % 3 = 1 THEN url END)::VARCHAR
       END AS raw_json,
       CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 3 = 1 THEN url ELSE 'None' END AS source_url,
       TIMESTAMP '{FETCHED_AT}' AS fetched_at
FROM pages""")
def envelope_from_body(spark, sf_dir):
    """SRC-13: pushed bodies -> envelopes with the body's source_url."""
    return requests.envelope_from_body(_bodies(spark, sf_dir), "body", FETCHED_AT)


@register("enrich_source_url", """
SELECT page_id,
  CASE WHEN page_id % 4 = 0 THEN '[' || CAST(page_id AS VARCHAR) || ']'
       ELSE json_object('page_id', page_id, 'source_url',
                        'https://api.weatherapi.com/v1/history.json?q=p' || CAST(page_id AS VARCHAR) || '&dt=2024-01-01')::VARCHAR
  END AS body
FROM pages""")
def enrich_source_url(spark, sf_dir):
    """SRC-14: set source_url inside object payloads (replacing the old
    value), leave array payloads alone."""
    p = _t(spark, sf_dir, "pages")
    k = F.col("page_id")
    body = (F.when(k % 4 == 0, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
            .otherwise(F.to_json(F.struct(k.alias("page_id"), F.col("url").alias("source_url")))))
    url = requests.source_url(F.concat(F.lit("p"), k.cast("string")), F.lit("2024-01-01"))
    b = p.select("page_id", body.alias("body"), url.alias("source_url"))
    return requests.with_source_url(b, "body", "source_url").select("page_id", "body")


@register("raw_weather_load", """
SELECT
  'https://api.weatherapi.com/v1/history.json?q=' ||
    CAST(CAST((user_id % 1200) - 600 AS DOUBLE) / 10.0 AS VARCHAR) || ',' ||
    CAST(CAST(((user_id // 1200) % 3600) - 1800 AS DOUBLE) / 10.0 AS VARCHAR) || '&dt=' ||
    strftime(CAST(ts AS DATE), '%Y-%m-%d') AS source_url,
  'City ' || CAST(user_id AS VARCHAR) AS city,
  TIMESTAMP '2024-02-01 06:00:00' AS fetched_at,
  CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_epoch
FROM events""")
def raw_weather_load(spark, sf_dir):
    """P-15: landed weather documents + their requests -> envelopes with
    secret-free source URLs, appended idempotently (a retry adds nothing);
    the stored payloads are unnested, so every hour is compared."""
    docs = fx.weather_documents(_t(spark, sf_dir, "events"))
    reqs = docs.select(
        F.concat(fx.user_lat(F.col("user_id")).cast("string"), F.lit(","),
                 fx.user_lon(F.col("user_id")).cast("string")).alias("location"),
        F.date_format("day", "yyyy-MM-dd").alias("date"), F.col("chunk").alias("part"),
        F.col("doc_new").alias("payload"))
    target = scratch_path(spark, "raw_weather_load")
    raw_load.load_weather(spark, reqs, target, FETCHED_AT)
    raw_load.load_weather(spark, reqs, target, FETCHED_AT)
    out = spark.read.parquet(target).select("source_url", "fetched_at", safe_parse("raw_json").alias("doc"))
    hours = out.select("source_url", "fetched_at", json_value("doc", "$.location.name").alias("city"),
                       F.explode(json_query_array("doc", "$.forecast.forecastday[0].hour")).alias("hour"))
    return hours.select(F.regexp_replace("source_url", "&part=[0-9]+$", "").alias("source_url"), "city", "fetched_at",
                        json_value("hour", "$.time_epoch").cast("bigint").alias("time_epoch"))
