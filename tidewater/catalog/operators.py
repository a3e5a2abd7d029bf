"""One query per relational operator: projections, filters, unnests,
aggregates, windows, sort and union."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from .. import operators as op
from ..functions import json_value, safe_parse
from ..session import configure
from .registry import register
from .sqlfrag import CUSTOMER_OBJECTS


def _t(spark, sf_dir, name):
    configure(spark)
    return fx.read_table(spark, sf_dir, name)


# ------------------------------------------------------------- windows

@register("row_number_latest", """
SELECT o_custkey, o_orderkey,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER) AS rn
FROM orders""")
def row_number_latest(spark, sf_dir):
    """WIN-1: ROW_NUMBER per customer, newest order first."""
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return op.rank_within(o, ["o_custkey"], "o_orderdate desc, o_orderkey desc").drop("o_orderdate")


@register("row_number_spread", """
SELECT l_linestatus, l_orderkey, l_linenumber,
  row_number() OVER (PARTITION BY l_linestatus ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS rn
FROM lineitem""")
def row_number_spread(spark, sf_dir):
    """WIN-1 over two keys, each holding about half of all rows."""
    rows = _t(spark, sf_dir, "lineitem").select("l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")
    return op.rank_spread(rows, ["l_linestatus"], "l_shipdate desc, l_orderkey, l_linenumber").drop("l_shipdate")


@register("top1_per_group", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def top1_per_group(spark, sf_dir):
    """TOP-1 + FLT-3 + PRJ-2: newest order per customer."""
    o = _t(spark, sf_dir, "orders")
    return op.where_rank_one(op.rank_within(o, ["o_custkey"], "o_orderdate desc, o_orderkey desc"))


@register("deduplicate_generic", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def deduplicate_generic(spark, sf_dir):
    """WIN-2: deduplicate(relation, partition_by, 'o_totalprice desc, o_orderkey')."""
    return op.deduplicate(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice desc, o_orderkey")


@register("drop_helper_column", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events)
WHERE rn = 1""")
def drop_helper_column(spark, sf_dir):
    """PRJ-2: ``select * except(rn)`` after the rank filter."""
    e = op.rank_within(_t(spark, sf_dir, "events"), ["user_id"], "ts desc, event_id")
    return op.except_columns(e.where(F.col("rn") == 1), "rn")


# ------------------------------------------------------------- projections

@register("rename_columns", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey FROM supplier")
def rename_columns(spark, sf_dir):
    """PRJ-3."""
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return op.rename(s, {"s_suppkey": "supplier_id", "s_name": "supplier_name"})


@register("struct_fields", """
SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS order_id, 'p-' || CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS unit_price
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def struct_fields(spark, sf_dir):
    """PRJ-4: struct field access after the unnest."""
    o = fx.orders_nested(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    items = op.unnest(o, "items", "item", keep=["order_id"])
    return op.struct_fields(items, "item", ["product_id", "quantity", "unit_price"], keep=["order_id"])


@register("computed_amount", """
SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS amount FROM lineitem""")
def computed_amount(spark, sf_dir):
    """PRJ-5: computed column."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return op.with_product(li, "l_quantity", "l_extendedprice", "amount").select("l_orderkey", "l_linenumber", "amount")


# ------------------------------------------------------------- filters

@register("filter_like", "SELECT page_id, url FROM pages WHERE url LIKE '%example.com%'")
def filter_like(spark, sf_dir):
    """FLT-1."""
    return op.where_like(_t(spark, sf_dir, "pages").select("page_id", "url"), "url", "%example.com%")


@register("filter_equal_null_safe", """
SELECT * FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END AS id FROM nation)
WHERE id = 1""")
def filter_equal(spark, sf_dir):
    """FLT-2: ``id = 1``; NULL ids drop."""
    n = _t(spark, sf_dir, "nation")
    x = n.select("n_nationkey", F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey")).alias("id"))
    return op.where_equal(x, "id", 1)


@register("filter_not_null_key", """
SELECT * FROM (SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey END AS customer_id, c_name FROM customer)
WHERE customer_id IS NOT NULL""")
def filter_not_null_key(spark, sf_dir):
    """FLT-4 / FLT-7: drop rows with a NULL key."""
    c = _t(spark, sf_dir, "customer")
    x = c.select(F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey")).alias("customer_id"), "c_name")
    return op.where_not_null(x, "customer_id")


def _item_mix(nation):
    k = F.col("n_nationkey").cast("string")
    m = F.col("n_nationkey") % 6
    item = (F.when(m == 0, F.concat(F.lit('{"k":'), k, F.lit("}")))
            .when(m == 1, k)
            .when(m == 2, F.concat(F.lit('"s'), k, F.lit('"')))
            .when(m == 3, F.concat(F.lit("["), k, F.lit("]")))
            .when(m == 4, F.lit("null"))
            .otherwise(F.concat(F.lit('"{\\"k\\":'), k, F.lit('}"'))))
    return (nation.groupBy("n_regionkey")
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit("]")).alias("doc")))


@register("filter_objects", "SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_nationkey % 6 = 0")
def filter_objects(spark, sf_dir):
    """FLT-5: only JSON objects survive (numbers, strings, arrays, null and a
    string holding object text do not)."""
    docs = _item_mix(_t(spark, sf_dir, "nation")).select(safe_parse("doc").alias("d"))
    items = op.unnest_path(docs, "d", "$", "item", keep=[])
    return op.keep_objects(items, "item").select(json_value("item", "$.k").cast("bigint").alias("k"))


@register("filter_array_roots", "SELECT n_nationkey FROM nation WHERE n_nationkey % 3 = 0")
def filter_array_roots(spark, sf_dir):
    """FLT-6: documents whose root is an array."""
    n = _t(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("string")
    m = F.col("n_nationkey") % 3
    doc = (F.when(m == 0, F.concat(F.lit("["), k, F.lit("]")))
           .when(m == 1, F.concat(F.lit('{"k":'), k, F.lit("}"))).otherwise(k))
    d = n.select("n_nationkey", safe_parse(doc).alias("d"))
    return op.keep_array_roots(d, "d").select("n_nationkey")


# ------------------------------------------------------------- unnest

@register("unnest_structs", """
SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS order_id, 'p-' || CAST(l_partkey AS VARCHAR) AS product_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def unnest_structs(spark, sf_dir):
    """LAT-1: ARRAY<STRUCT> unnest; orders without items vanish."""
    o = fx.orders_nested(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    return op.unnest(o, "items", "item", keep=["order_id"]).select("order_id", F.col("item.product_id").alias("product_id"))


@register("unnest_json_root", f"SELECT id AS customer_id FROM ({CUSTOMER_OBJECTS})")
def unnest_json_root(spark, sf_dir):
    """LAT-2: unnest the root array ``$`` of each document."""
    docs = fx.customer_documents(_t(spark, sf_dir, "customer")).select(safe_parse("raw_json").alias("d"))
    items = op.unnest_path(docs, "d", "$", "x", keep=[])
    return items.select(json_value("x", "$.id").cast("bigint").alias("customer_id"))


@register("unnest_two_levels", """
SELECT 'City ' || CAST(user_id AS VARCHAR) AS city, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_epoch
FROM events""")
def unnest_two_levels(spark, sf_dir):
    """LAT-3 / LAT-4: forecastday[] then hour[], parent keys carried."""
    d = fx.weather_documents(_t(spark, sf_dir, "events")).select(safe_parse("doc_new").alias("j"))
    d = d.select(json_value("j", "$.location.name").alias("city"), "j")
    days = op.unnest_path(d, "j", "$.forecast.forecastday", "day", keep=["city"])
    days = days.select("city", json_value("day", "$.date").alias("day_text"), F.col("day").alias("day_v"))
    hours = op.unnest_path(days, "day_v", "$.hour", "hour", keep=["city", "day_text"])
    return hours.select("city", F.col("day_text").alias("day"),
                        json_value("hour", "$.time_epoch").cast("bigint").alias("time_epoch"))


@register("explode_tolerant", f"SELECT email FROM ({CUSTOMER_OBJECTS})")
def explode_tolerant(spark, sf_dir):
    """LAT-5: every customer object survives the junk documents and items."""
    out = op.explode_tolerant(fx.customer_documents_dirty(_t(spark, sf_dir, "customer")), "raw_json", "obj")
    return out.select(json_value("obj", "$.email").alias("email"))


@register("explode_strict", f"SELECT email FROM ({CUSTOMER_OBJECTS})")
def explode_strict(spark, sf_dir):
    """LAT-6: array documents exploded; object and scalar roots skipped."""
    docs = fx.customer_documents(_t(spark, sf_dir, "customer")).select("raw_json")
    n = _t(spark, sf_dir, "nation")
    other = n.select(F.when(F.col("n_nationkey") % 2 == 0,
                            F.to_json(F.struct("n_nationkey", "n_name")))
                     .otherwise(F.col("n_nationkey").cast("string")).alias("raw_json"))
    out = op.explode_strict(docs.unionByName(other), "raw_json", "obj")
    return out.select(json_value("obj", "$.email").alias("email"))


# ------------------------------------------------------------- aggregates

@register("agg_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg_count(spark, sf_dir):
    """AGG-1."""
    g = op.group_stats(_t(spark, sf_dir, "events"), ["event_type"], "value", stats=("count",))
    return g.withColumnRenamed("count", "n")


@register("agg_avg", "SELECT event_type, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type")
def agg_avg(spark, sf_dir):
    """AGG-2."""
    g = op.group_stats(_t(spark, sf_dir, "events"), ["event_type"], "value", stats=("avg",))
    return g.withColumnRenamed("avg", "avg_value")


@register("agg_min", "SELECT event_type, min(value) AS min_value FROM events GROUP BY event_type")
def agg_min(spark, sf_dir):
    """AGG-3."""
    g = op.group_stats(_t(spark, sf_dir, "events"), ["event_type"], "value", stats=("min",))
    return g.withColumnRenamed("min", "min_value")


@register("agg_max", "SELECT event_type, max(value) AS max_value FROM events GROUP BY event_type")
def agg_max(spark, sf_dir):
    """AGG-4."""
    g = op.group_stats(_t(spark, sf_dir, "events"), ["event_type"], "value", stats=("max",))
    return g.withColumnRenamed("max", "max_value")


@register("agg_count_distinct", """
SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def agg_count_distinct(spark, sf_dir):
    """AGG-5."""
    e = _t(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("day"), "user_id")
    return op.distinct_per_group(e, ["day"], "user_id", "users")


@register("group_by_many", """
SELECT event_type, CAST(ts AS DATE) AS day, user_id % 10 AS user_bucket, count(*) AS n,
       round(avg(value), 6) AS avg_value, min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY 1, 2, 3""")
def group_by_many(spark, sf_dir):
    """AGG-6: multi-key GROUP BY with several aggregates."""
    e = _t(spark, sf_dir, "events").select(
        "event_type", F.to_date(F.col("ts").cast("timestamp")).alias("day"),
        (F.col("user_id") % 10).alias("user_bucket"), "value")
    g = op.group_stats(e, ["event_type", "day", "user_bucket"], "value")
    return op.rename(g, {"count": "n", "avg": "avg_value", "min": "min_value", "max": "max_value"})


# ------------------------------------------------------------- sort, union

@register("order_by_day", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def order_by_day(spark, sf_dir):
    """SRT-1: ORDER BY ascending (NULLs first) over a daily count."""
    e = _t(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("day"))
    return e.groupBy("day").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("day").asc_nulls_first())


@register("union_all", """
SELECT c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_name AS name, 'supplier' AS kind FROM supplier""")
def union_all(spark, sf_dir):
    """SET-1: UNION ALL by column name."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    s = _t(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return c.unionByName(s)
