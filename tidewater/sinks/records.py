"""One JSON record per produced message, keyed by time and name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import compact_stamp, rstrip_slash


def record_keys(records: DataFrame, folder: str = "exercise/", written_at=None) -> DataFrame:
    """SNK-9 key: ``{folder without trailing /}/{yyyyMMdd'T'HHmmss'Z'}_{name|unknown}.json``
    plus the record serialised as JSON text."""
    name = F.coalesce(F.col("name"), F.lit("unknown"))
    dest = F.concat(rstrip_slash(F.lit(folder)), F.lit("/"), compact_stamp(written_at),
                    F.lit("_"), name, F.lit(".json"))
    return records.select(dest.alias("dest"),
                          F.to_json(F.struct(*[F.col(c) for c in records.columns])).alias("payload"))


def write_records(records: DataFrame, root: str, folder: str = "exercise/",
                  written_at=None) -> DataFrame:
    """SNK-9: write the records as JSON lines under ``root``, partitioned by
    the write day; every line carries its object key (``dest``) instead of
    one tiny object per record.  Returns the written (dest, payload) rows."""
    keyed = record_keys(records, folder, written_at)
    keyed = keyed.withColumn("written_day", F.regexp_extract("dest", r"/(\d{8})T", 1))
    keyed.write.mode("append").partitionBy("written_day").json(root)
    return keyed.select("dest", "payload")
