"""One query per scalar function (JSON paths, casts, keys, casing, time)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import functions as fn
from ..session import configure
from .registry import register
from .sqlfrag import initcap, title


def _t(spark, sf_dir, name):
    configure(spark)
    return fx.read_table(spark, sf_dir, name)


def _event_docs(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    doc = F.concat(F.lit('{"k":'), k, F.lit(',"o":{"x":'), k, F.lit('},"a":['), k, F.lit(',"'),
                   F.col("event_type"), F.lit('",{"x":1},null],"n":null,"s":"'), F.col("event_type"),
                   F.lit('"}'))
    return e.select("event_id", "event_type", fn.safe_parse(doc).alias("d"))


K = "json_extract_string(props, '$.k')"


@register("json_parse_safe_vs_strict", f"""
SELECT event_id, event_id % 11 <> 0 AS safe_ok, CAST({K} AS BIGINT) AS k FROM events""")
def json_parse_safe_vs_strict(spark, sf_dir):
    """FN-1 (bad text -> NULL) and FN-2 (valid text parsed strictly)."""
    e = _t(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 11 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    return e.select("event_id", fn.safe_parse(text).isNotNull().alias("safe_ok"),
                    fn.json_value(fn.strict_parse("props"), "$.k").cast("bigint").alias("k"))


@register("json_value", f"""
SELECT event_id, {K} AS v_k, NULL::VARCHAR AS v_o, NULL::VARCHAR AS v_a, NULL::VARCHAR AS v_n,
       event_type AS v_s, NULL::VARCHAR AS v_missing, '1' AS v_ox FROM events""")
def json_value_q(spark, sf_dir):
    """FN-3: scalars only; object, array, JSON null and missing -> NULL."""
    d = _event_docs(spark, sf_dir)
    jv = fn.json_value
    return d.select("event_id", jv("d", "$.k").alias("v_k"), jv("d", "$.o").alias("v_o"),
                    jv("d", "$.a").alias("v_a"), jv("d", "$.n").alias("v_n"), jv("d", "$.s").alias("v_s"),
                    jv("d", "$.missing").alias("v_missing"), jv("d", "$.a[2].x").alias("v_ox"))


@register("json_query", f"""
SELECT event_id, '{{"x":' || {K} || '}}' AS q_o, '"' || event_type || '"' AS q_s, {K} AS q_k,
       NULL::VARCHAR AS q_missing FROM events""")
def json_query_q(spark, sf_dir):
    """FN-4: JSON text of the value (objects, quoted strings)."""
    d = _event_docs(spark, sf_dir)
    jq = fn.json_query
    return d.select("event_id", jq("d", "$.o").alias("q_o"), jq("d", "$.s").alias("q_s"),
                    jq("d", "$.k").alias("q_k"), jq("d", "$.missing").alias("q_missing"))


@register("json_query_array", f"""
SELECT event_id, 4 AS a_len, {K} AS a_first, event_type AS a_second, TRUE AS o_not_array FROM events""")
def json_query_array_q(spark, sf_dir):
    """FN-5: the array at a path (mixed items kept); non-array -> NULL."""
    d = _event_docs(spark, sf_dir)
    a = fn.json_query_array("d", "$.a")
    return d.select("event_id", F.size(a).alias("a_len"),
                    fn.json_value(a[0]).alias("a_first"), fn.json_value(a[1]).alias("a_second"),
                    fn.json_query_array("d", "$.o").isNull().alias("o_not_array"))


@register("cast_strict", """
SELECT c_custkey AS customer_id, DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup,
       c_acctbal AS acctbal FROM customer""")
def cast_strict(spark, sf_dir):
    """FN-6: strict casts of text to BIGINT, DATE, DOUBLE."""
    c = _t(spark, sf_dir, "customer")
    c = fx.customer_objects(c, extra=["c_acctbal"])
    return c.select(fn.strict_cast(F.col("id").cast("string"), "bigint").alias("customer_id"),
                    fn.strict_cast("signup_date", "date").alias("signup"),
                    fn.strict_cast(F.col("c_acctbal").cast("string"), "double").alias("acctbal"))


def _messy_numbers(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    k, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 5
    s = (F.when(m == 0, F.concat(F.lit("x"), k)).when(m == 1, F.concat(k, F.lit(".0")))
         .when(m == 2, k).when(m == 3, F.concat(F.lit("-"), k)).otherwise(F.lit("")))
    return c.select("c_custkey", s.alias("s"))


@register("cast_safe", """
WITH s AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'x' || c_custkey WHEN 1 THEN c_custkey || '.0'
  WHEN 2 THEN CAST(c_custkey AS VARCHAR) WHEN 3 THEN '-' || c_custkey ELSE '' END AS s FROM customer)
SELECT c_custkey, CASE WHEN regexp_full_match(s, '-?[0-9]+') THEN CAST(s AS BIGINT) END AS as_int,
       TRY_CAST(s AS DECIMAL(38,9)) AS as_numeric FROM s""")
def cast_safe(spark, sf_dir):
    """FN-7: SAFE_CAST to INT64 ('12.0' is not an integer) and NUMERIC."""
    s = _messy_numbers(spark, sf_dir)
    return s.select("c_custkey", fn.safe_cast("s", "bigint").alias("as_int"),
                    fn.safe_cast("s", fn.NUMERIC).alias("as_numeric"))


@register("to_numeric_coerce", """
SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 4 THEN 100 ELSE c_custkey END AS customer_id
FROM customer""")
def to_numeric_coerce(spark, sf_dir):
    """FN-16: tolerant numeric parse to an integer id."""
    c = _t(spark, sf_dir, "customer")
    k, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 5
    s = (F.when(m == 0, F.concat(F.lit("x"), k)).when(m == 1, F.concat(k, F.lit(".0")))
         .when(m == 2, F.concat(F.lit(" "), k, F.lit(" "))).when(m == 3, k).otherwise(F.lit("1e2")))
    return c.select("c_custkey", fn.to_numeric_coerce(s).alias("customer_id"))


# Layouts of a date d, by customer number; the last three are no dates.
_DATE_TEXTS = ("yyyy-MM-dd", "yyyy-MM-dd'T'10:00:00'Z'", "yyyy-MM-dd 23:59:59.123", "yyyy-MM-dd'T'10:00:00+02:00", "yyyy/MM/dd", "yyyyMMdd",
               "MM/dd/yyyy", "MMM d, yyyy", "d MMMM yyyy", "dd-MMM-yyyy", "EEE, dd MMM yyyy 07:08:09 'GMT'", "yyyy-MM", "2024-13-45", "'not a date'", "yyyy-MM-dd 25:00")


@register("to_date_coerce", """
SELECT c_custkey, CASE WHEN c_custkey % 15 = 11 THEN date_trunc('month', DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER))::DATE
                       WHEN c_custkey % 15 < 11 THEN DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) END AS d
FROM customer""")
def to_date_coerce(spark, sf_dir):
    """FN-17: tolerant date parse by the literal's shape; bad text -> NULL."""
    c = fx.customer_objects(_t(spark, sf_dir, "customer"))
    day = F.col("signup_date").cast("date")
    text = F.lit(None).cast("string")
    for i, layout in enumerate(_DATE_TEXTS):
        text = F.when(F.col("c_custkey") % 15 == i, F.date_format(day, layout)).otherwise(text)
    return c.select("c_custkey", fn.to_date_coerce(text).alias("d"))


@register("json_rewritten", """
SELECT c_custkey, '{"name": "' || c_name || ' å😀 / \\"q\\"\\n", "id": ' || c_custkey ||
  ', "tags": [], "o": {"b": null, "a": [1.50, true, "x,y:z", "\\\\u0041"]}}' AS raw_json FROM customer""")
def json_rewritten(spark, sf_dir):
    """FN-24 / SRC-1: escaped, pretty-printed documents re-serialised."""
    c = _t(spark, sf_dir, "customer")
    text = F.concat(F.lit('{\n  "name" : "'), F.replace("c_name", F.lit("#"), F.lit("\\u0023")), F.lit(r' \u00e5\uD83D\ude00 \/ \u0022q\"\u000A",\t"id":'.replace(r"\t", "\t")),
                    F.col("c_custkey").cast("string"), F.lit(',\r\n"tags":[ ], "o" :{ "b" :null , "a":[1.50,true, "x,y:z","\\\\u0041"]\n}\n}'))
    return c.select("c_custkey", fn.json_rewritten(text).alias("raw_json"))


@register("epoch_to_timestamp", """
SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS epoch,
       make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS observed_at FROM events""")
def epoch_to_timestamp(spark, sf_dir):
    """FN-9: TIMESTAMP_SECONDS."""
    e = _t(spark, sf_dir, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"))
    return e.select("event_id", "epoch", fn.epoch_to_timestamp("epoch").alias("observed_at"))


@register("date_utc", """
SELECT event_id, CAST(ts AS DATE) AS day_of_ts, CAST(ts AS DATE) AS day_of_text FROM events""")
def date_utc(spark, sf_dir):
    """FN-8: DATE(timestamp) and DATE(string) in UTC."""
    e = _t(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select("event_id", fn.date_of(ts).alias("day_of_ts"),
                    fn.date_of(F.date_format(ts, "yyyy-MM-dd")).alias("day_of_text"))


@register("md5_key", """
SELECT c_custkey, md5(CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_custkey AS VARCHAR) || '|' || c_name) AS key_hash
FROM customer""")
def md5_key(spark, sf_dir):
    """FN-11: TO_HEX(MD5(lat,lon|epoch-style key))."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.md5_hex(fn.location_key("c_nationkey", "c_custkey", "c_name")).alias("key_hash"))


@register("composite_key", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || ',' ||
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END || '|' || CAST(c_custkey AS VARCHAR) AS natural_key
FROM customer""")
def composite_key(spark, sf_dir):
    """FN-10 / FN-12: CONCAT-based key; one NULL part -> NULL key."""
    c = _t(spark, sf_dir, "customer")
    seg = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    return c.select("c_custkey", fn.natural_key("c_nationkey", ("sep", ","), seg, ("sep", "|"),
                                                "c_custkey").alias("natural_key"))


@register("sha256_signature", """
SELECT c_custkey, substr(sha256(c_name || 's3cr3t'), 1, 12) AS signature FROM customer""")
def sha256_signature(spark, sf_dir):
    """FN-19."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.sha256_prefix(F.concat("c_name", F.lit("s3cr3t"))).alias("signature"))


_PART_TEXT_SQL = "p_name || '-' || lower(p_type) || ' o''' || p_brand || ' mc_x.y(z)'"


def _part_text(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    s = F.concat(F.col("p_name"), F.lit("-"), F.lower("p_type"), F.lit(" o'"), F.col("p_brand"),
                 F.lit(" mc_x.y(z)"))
    return p.select("p_partkey", s.alias("s"))


@register("initcap_sql", f"SELECT p_partkey, {initcap(_PART_TEXT_SQL)} AS s FROM part")
def initcap_sql(spark, sf_dir):
    """FN-13: warehouse INITCAP (apostrophe is not a delimiter)."""
    return _part_text(spark, sf_dir).select("p_partkey", fn.initcap_sql("s").alias("s"))


@register("title_python", f"SELECT p_partkey, {title(_PART_TEXT_SQL)} AS s FROM part")
def title_python(spark, sf_dir):
    """FN-14: Python str.title()."""
    return _part_text(spark, sf_dir).select("p_partkey", fn.title_python("s").alias("s"))


@register("initcap_variants", f"""
SELECT c_custkey, {initcap("c_mktsegment || ' o''' || lower(c_name)")} AS sql_style,
       {title("c_mktsegment || ' o''' || lower(c_name)")} AS python_style FROM customer""")
def initcap_variants(spark, sf_dir):
    """FN-13 vs FN-14 on the customer names."""
    c = fx.customer_objects(_t(spark, sf_dir, "customer"))
    return c.select("c_custkey", fn.initcap_sql("name").alias("sql_style"),
                    fn.title_python("name").alias("python_style"))


@register("lower_email", "SELECT c_custkey, lower(replace(c_name, '#', '.') || '@Example.COM') AS email FROM customer")
def lower_email(spark, sf_dir):
    """FN-15."""
    c = fx.customer_objects(_t(spark, sf_dir, "customer"))
    return c.select("c_custkey", fn.lower("email").alias("email"))


@register("message_template", "SELECT c_custkey, 'Hello, ' || c_name || '!' AS message FROM customer")
def message_template(spark, sf_dir):
    """FN-20."""
    return _t(spark, sf_dir, "customer").select("c_custkey", fn.greeting("c_name").alias("message"))


@register("utc_stamp", """
SELECT event_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END
    || '+00:00' AS iso,
  strftime(ts, '%Y%m%dT%H%M%SZ') AS compact
FROM events""")
def utc_stamp(spark, sf_dir):
    """FN-21: ISO-8601 and compact UTC stamps of a given time."""
    e = _t(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select("event_id", fn.utc_stamp(ts).alias("iso"), fn.compact_stamp(ts).alias("compact"))


@register("yesterday", """
SELECT event_id, strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS yesterday FROM events""")
def yesterday(spark, sf_dir):
    """FN-22: the UTC day before a given time."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", fn.yesterday(F.col("ts").cast("timestamp")).alias("yesterday"))


@register("fallback_chain", """
WITH c AS (SELECT c_custkey,
  CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END AS a,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'seg-' || CAST(c_nationkey AS VARCHAR) END AS b FROM customer)
SELECT c_custkey, coalesce(nullif(a, ''), nullif(b, ''), 'default') AS chain,
       coalesce(a, 'default') AS presence FROM c""")
def fallback_chain(spark, sf_dir):
    """FN-25: ``a or b or c`` ('' is missing) vs presence-only coalesce."""
    c = _t(spark, sf_dir, "customer")
    m = F.col("c_custkey") % 3
    a = F.when(m == 1, F.lit("")).when(m == 2, F.col("c_mktsegment"))
    b = F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit("seg-"), F.col("c_nationkey").cast("string")))
    return c.select("c_custkey", fn.fallback(a, b, "default").alias("chain"),
                    fn.fallback(a, "default", empty_is_missing=False).alias("presence"))
