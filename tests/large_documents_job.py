"""Run by test_large_documents in a session of its own with a larger heap:
prints one line of results."""

import json
import sys

from pyspark.sql import functions as F

from tidewater.operators import explode_tolerant, quarantine
from tidewater.plans import customers
from tidewater.session import build_session

spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.driver.memory": "10g"})
spark.sparkContext.setLogLevel("ERROR")
customer = lambda i: F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"name":"'), F.repeat(F.lit("n"), 75), F.lit('","signup_date":"2024-01-05"}'))
array = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2_000_000)), customer), ","), F.lit("]"))
large = spark.range(1).select(array.alias("raw_json"))
strict, tolerant = (f(large).agg(F.count("customer_id"), F.sum("customer_id")).first() for f in (customers.stg_customers, customers.stg_customers_tolerant))
member = F.concat(F.lit('"m'), F.col("id").cast("string"), F.lit('":"'), F.repeat(F.lit("x"), 50_000_000), F.lit('"'))
item = spark.range(3).agg(F.array_join(F.collect_list(member), ",").alias("members"))
over = item.select(F.concat(F.lit('[{"id":1},7,{'), F.col("members"), F.lit('},{"id":3}]')).alias("raw_json"))
kept = sorted(r[0] for r in explode_tolerant(over).select(F.try_variant_get("obj", "$.id", "int")).collect())
out = [tuple(r) for r in quarantine(over).collect()]
print(json.dumps({"bytes": large.select(F.octet_length("raw_json")).first()[0], "strict": list(strict), "tolerant": list(tolerant), "kept": kept, "rejected": out}))
sys.stdout.flush()
spark.stop()
