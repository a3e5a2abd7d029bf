"""Customer documents through the strict, tolerant, semi-raw, script,
dedup and signup plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import explode_tolerant, quarantine
from ..plans import customers as cu
from ..session import configure, ensure_local_dir, scratch_path
from .registry import register
from .sqlfrag import CUSTOMER_OBJECTS, initcap, title

AS_OF = "2024-02-01 06:00:00"


def _customer(spark, sf_dir):
    configure(spark)
    return fx.read_table(spark, sf_dir, "customer")


@register("customers_strict", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id, {initcap('name')} AS customer_name, lower(email) AS email,
       CAST(signup_date AS DATE) AS signup_date
FROM o""")
def customers_strict(spark, sf_dir):
    """P-3 over clean customer array documents."""
    return cu.stg_customers(fx.customer_documents(_customer(spark, sf_dir)))


@register("customers_tolerant", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id,
       CASE WHEN k = 4 THEN NULL ELSE {title('name')} END AS customer_name,
       lower(email) AS customer_email,
       CASE WHEN k = 3 THEN NULL ELSE CAST(signup_date AS DATE) END AS signup_date
FROM o WHERE k <> 2""")
def customers_tolerant(spark, sf_dir):
    """P-4 over documents with every error case mixed in."""
    return cu.stg_customers_tolerant(fx.customer_documents_dirty(_customer(spark, sf_dir)))


@register("document_quarantine", f"""
WITH o AS ({CUSTOMER_OBJECTS}),
b AS (SELECT CAST(floor(id / 100) AS BIGINT) AS blk, count(*) AS objects FROM o GROUP BY 1)
SELECT 'data/customers_' || blk || '.json' AS source,
       CASE WHEN blk % 4 = 0 THEN objects END AS objects,
       CASE WHEN blk % 4 <> 0 THEN 'the text is not one JSON document' END AS reason
FROM b""")
def document_quarantine(spark, sf_dir):
    """LAT-5 + SRC-2 by document form: whole arrays are loaded item by item;
    text behind an array, two arrays and cut arrays go to the quarantine with
    their reason, none of them half loaded."""
    docs = fx.customer_documents(_customer(spark, sf_dir))
    t, form = F.col("raw_json"), F.regexp_extract("source", "([0-9]+)", 1).cast("bigint") % 4
    docs = docs.select("source", F.when(form == 1, F.concat(t, F.lit(" oops"))).when(form == 2, F.concat(t, t))
                       .when(form == 3, F.rtrim(t, F.lit("]"))).otherwise(t).alias("raw_json"))
    loaded = explode_tolerant(docs, keep=["source"]).groupBy("source").agg(F.count(F.lit(1)).alias("objects"))
    rejected = quarantine(docs, keep=["source"])
    return loaded.select("source", "objects", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("source", F.lit(None).cast("bigint").alias("objects"), "reason"))


@register("customers_semi_raw", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT name AS full_name, CAST(signup_date AS DATE) AS signup FROM o""")
def customers_semi_raw(spark, sf_dir):
    """SRC-4 (array scan with defaults) -> P-5."""
    semi = cu.semi_raw_rows(fx.customer_documents(_customer(spark, sf_dir)), loaded_at=AS_OF)
    return cu.stg_customers_semi_raw(semi)


@register("scan_json_array_defaults", f"""
WITH c AS (SELECT c_custkey AS k, c_name AS n FROM customer)
SELECT CASE WHEN k % 7 = 0 THEN 0 WHEN k % 7 <> 1 THEN k END AS customer_id,
       CASE WHEN k % 5 IN (0, 2) THEN '' WHEN k % 5 <> 1 THEN n END AS name,
       CASE WHEN k % 3 = 0 THEN '' ELSE 'c' || k || '@example.org' END AS email,
       '' AS signup_date, TIMESTAMP '{AS_OF}' AS loaded_at
FROM c""")
def scan_json_array_defaults(spark, sf_dir):
    """SRC-4, PRJ-7, FN-18: arrays whose objects miss keys, hold JSON null or
    hold empty text; only a missing key takes its default."""
    k, n = F.col("c_custkey"), F.col("c_name")
    member = lambda key, value: F.concat(F.lit(f'"{key}":'), value)
    number = F.when(k % 7 == 1, member("id", F.lit("null"))).when(k % 7 != 0, member("id", k.cast("string")))
    name = (F.when(k % 5 == 1, member("name", F.lit("null"))).when(k % 5 == 2, member("name", F.lit('""')))
            .when(k % 5 != 0, member("name", F.concat(F.lit('"'), n, F.lit('"')))))
    email = F.when(k % 3 != 0, member("email", F.concat(F.lit('"c'), k.cast("string"), F.lit('@example.org"'))))
    item = F.concat(F.lit("{"), F.concat_ws(",", number, name, email), F.lit("}"))
    docs = (_customer(spark, sf_dir).groupBy(F.floor(k / 50).alias("doc")).agg(F.collect_list(item).alias("items"))  # 50 items a document
            .select(F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("raw_json")))
    return cu.semi_raw_rows(docs, loaded_at=AS_OF)


@register("customers_script", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id, {title('name')} AS customer_name, lower(email) AS customer_email,
       CAST(signup_date AS DATE) AS signup_date, TIMESTAMP '{AS_OF}' AS transformed_at
FROM o""")
def customers_script(spark, sf_dir):
    """P-6: strict explode + title/lower + run time (fixed for the check)."""
    return cu.transformed_customers(fx.customer_documents(_customer(spark, sf_dir)),
                                    transformed_at=AS_OF)


@register("customers_deduped", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id, name || ' v3' AS name, email, signup_date,
       TIMESTAMP '2024-02-01 03:00:00' AS loaded_at
FROM o""")
def customers_deduped(spark, sf_dir):
    """P-7: newest of three deliveries per customer."""
    return cu.stg_customers_deduped(fx.customers_semi_raw(_customer(spark, sf_dir)))


@register("daily_signups", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT CAST(signup_date AS DATE) AS signup_date, count(DISTINCT id) AS daily_signups
FROM o GROUP BY 1 ORDER BY 1""")
def daily_signups(spark, sf_dir):
    """P-8 over P-3, ordered at read (SRT-1)."""
    docs = fx.customer_documents(_customer(spark, sf_dir))
    return cu.int_customer_signups(cu.stg_customers(docs)).orderBy("signup_date")


def _customer_landing(spark, sf_dir):
    root = ensure_local_dir(scratch_path(spark, "landing_customers"))
    docs = fx.customer_documents(_customer(spark, sf_dir))
    named = docs.select(F.regexp_extract("source", r"([^/]+)$", 1).alias("name"),
                        F.col("raw_json").alias("text"))
    fx.write_documents(spark, named, root)
    return root


@register("semi_raw_load", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id, name, email, signup_date, TIMESTAMP '{AS_OF}' AS loaded_at FROM o""")
def semi_raw_load(spark, sf_dir):
    """SRC-4 + SNK-3/4/5/11: JSON-array files loaded into the semi-raw table."""
    root = _customer_landing(spark, sf_dir)
    base = scratch_path(spark, "semi_raw_db")
    db = "tw_" + base.rsplit("-", 1)[-1]
    cu.load_semi_raw(spark, root + "/*.json", db, "customers", base + "/customers", AS_OF)
    return spark.table(f"{db}.customers")


@register("transformed_customers_load", f"""
WITH o AS ({CUSTOMER_OBJECTS})
SELECT id AS customer_id, {title('name')} AS customer_name, lower(email) AS customer_email,
       CAST(signup_date AS DATE) AS signup_date, TIMESTAMP '{AS_OF}' AS transformed_at
FROM o""")
def transformed_customers_load(spark, sf_dir):
    """P-6 with its write: REQUIRED-column table, skip-if-empty, append."""
    path = scratch_path(spark, "transformed_customers")
    name = "transformed_customers_" + path.rsplit("-", 1)[-1]
    docs = fx.customer_documents(_customer(spark, sf_dir))
    nothing = docs.where(F.lit(False))                     # an empty delivery writes nothing
    assert not cu.load_transformed_customers(spark, nothing, name, path, AS_OF)
    assert cu.load_transformed_customers(spark, docs, name, path, AS_OF)
    return spark.table(name)
