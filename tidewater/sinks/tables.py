"""Envelope serialisation, appends, table creation and materialisations."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text, now_or, row_id
from ..session import scratch_path, shared_dir


def to_envelope(payload: DataFrame, payload_col: str, source_col: str, fetched_at=None,
                source_name: str = "source_url") -> DataFrame:
    """SNK-1: payload (struct or VARIANT) -> ``(raw_json, <source>, fetched_at)``."""
    return payload.select(json_text(payload_col).alias("raw_json"),
                          F.col(source_col).alias(source_name),
                          now_or(fetched_at).alias("fetched_at"))


def with_row_id(df: DataFrame, source_col: str = "source_url") -> DataFrame:
    """SNK-2 key: ``source:fetched_at`` plus the fetch day used to partition."""
    return (df.withColumn("row_id", row_id(source_col, "fetched_at"))
              .withColumn("fetched_date", F.to_date("fetched_at")))


def require_not_null(df: DataFrame, cols) -> DataFrame:
    """SNK-4 REQUIRED columns: a NULL fails the write (raise_error)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(F.col(c).isNull(),
                                       F.raise_error(F.lit(f"NULL in required column {c}")))
                             .otherwise(F.col(c)))
    return out


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """SNK-5: ``CREATE DATABASE IF NOT EXISTS``, stored below the shared
    folder unless a location is given (never the local default warehouse)."""
    location = location or f"{shared_dir(spark)}/warehouse/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def ensure_table(spark: SparkSession, name: str, ddl: str, location: str,
                 partitioned_by: str | None = None) -> None:
    """SNK-4: ``CREATE TABLE IF NOT EXISTS name (ddl) USING parquet``
    at a shared location; ``ddl`` may carry ``NOT NULL``."""
    part = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part} LOCATION '{location}'")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def append_plain(df: DataFrame, path: str, partition_by=None) -> None:
    """SNK-3: plain append; re-running it duplicates rows (as the reference)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


# Keys that a load must treat apart are broadcast up to this number; beyond
# it they are joined by key.
BROADCAST_KEYS = 200_000
# Open files of a writing task; rows of more partitions than that are sorted.
OPEN_FILES = 8


def batch_keys(batch: DataFrame, key: str, part: str) -> DataFrame:
    """One narrow row (part, key, ``_n`` copies) per key of the batch.

    A NULL in either fails, and so do two different rows under one key:
    neither can be told apart on a retry.  Rows are compared by a hash of all
    columns, so no payload leaves its task."""
    others = [c for c in batch.columns if c not in (key, part)]
    content = F.xxhash64(*others) if others else F.lit(0).cast("bigint")
    clash = F.raise_error(F.concat(F.lit("different rows share the key "), F.col(key).cast("string")))
    return (require_not_null(batch.select(part, key, content.alias("_content")), [part, key])
            .groupBy(part, key).agg(F.count(F.lit(1)).alias("_n"), F.min("_content").alias("_lo"), F.max("_content").alias("_hi"))
            .withColumn("_n", F.when(F.col("_lo") != F.col("_hi"), clash.cast("bigint")).otherwise(F.col("_n")))
            .select(part, key, "_n"))


def key_exceptions(batch: DataFrame, stored: DataFrame | None, key: str, part: str, on: list | None = None) -> DataFrame:
    """The keys of the batch that are stored already (``_stored``) or come
    more than once: (part, key, _stored).  Only keys are joined.  ``on`` names
    the join columns where the key alone tells the partition, so that a table
    bucketed by it is read without a shuffle."""
    keys = batch_keys(batch, key, part)
    if stored is None:
        keys = keys.withColumn("_stored", F.lit(False))
    else:
        on = on or [part, key]
        keys = keys.join(stored.select(*on).withColumn("_stored", F.lit(True)), on, "left").withColumn("_stored", F.coalesce("_stored", F.lit(False)))
    return keys.where(F.col("_stored") | (F.col("_n") > 1)).select(part, key, "_stored")


def _without(batch: DataFrame, exceptions: DataFrame, key: str, part: str) -> DataFrame:
    """The batch without its excepted keys, plus one copy of every key that
    comes repeatedly but is not stored.  Without exceptions it is the batch
    itself: one scan, no exchange."""
    path = scratch_path(batch.sparkSession, "append_keys")
    exceptions.write.parquet(path)
    found = batch.sparkSession.read.schema(exceptions.schema).parquet(path)
    counts = found.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_stored")).alias("repeated")).first()
    if counts.n == 0:
        return batch
    hinted = F.broadcast if counts.n <= BROADCAST_KEYS else (lambda df: df)
    out = batch.join(hinted(found.select(part, key)), [part, key], "left_anti")
    if counts.repeated:
        again = batch.join(hinted(found.where(~F.col("_stored")).select(part, key)), [part, key], "left_semi")
        out = out.unionByName(again.dropDuplicates([part, key]).select(*out.columns))
    return out


def _days(batch: DataFrame, part: str) -> list:
    """The batch's partitions: one value per calendar day, whatever the rows."""
    return [r[0] for r in batch.select(part).distinct().collect()]


def stored_rows(spark: SparkSession, path: str, batch: DataFrame, part: str = "fetched_date") -> DataFrame | None:
    """The table at ``path``, only the batch's days; None if there is none."""
    return spark.read.parquet(path).where(F.col(part).isin(_days(batch, part))) if _exists(spark, path) else None


def new_rows(spark: SparkSession, batch: DataFrame, path: str, key: str = "row_id",
             part: str = "fetched_date") -> DataFrame:
    """Rows of ``batch`` not yet in the table at ``path``, one per key.

    Duplicate and stored keys are found on narrow columns (of the table only
    the row keys of the batch's days are read); the rows themselves are read
    once more and neither sorted nor shuffled but where a key repeats or more
    than ``BROADCAST_KEYS`` keys are stored already."""
    return _without(batch, key_exceptions(batch, stored_rows(spark, path, batch, part), key, part), key, part)


@contextlib.contextmanager
def open_files(spark: SparkSession, files: int = OPEN_FILES):
    """Let writing tasks keep ``files`` files open instead of sorting rows by
    partition first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_idempotent(spark: SparkSession, batch: DataFrame, path: str, key: str = "row_id",
                      part: str = "fetched_date") -> dict:
    """SNK-2 (+SNK-10): append the rows whose ``key`` is new; re-delivering
    a batch inserts nothing.  Returns ``{"inserted": n}`` from an observed
    metric of the write itself (no second pass over the data)."""
    rows = new_rows(spark, batch, path, key, part)
    obs = Observation("append")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("inserted"))
    with open_files(spark):
        rows.write.mode("append").partitionBy(part).parquet(path)
    return {"inserted": int(obs.get.get("inserted", 0))}


def ensure_raw_table(spark: SparkSession, name: str, location: str, source_col: str = "source_url", buckets: int = 32) -> None:
    """SNK-4 for SNK-2: a raw envelope table with REQUIRED columns, partitioned
    by fetch day and bucketed by ``row_id``.  An existing folder's partitions
    are registered."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (raw_json STRING NOT NULL, {source_col} STRING NOT NULL, fetched_at TIMESTAMP NOT NULL, "
              f"row_id STRING NOT NULL, fetched_date DATE) USING parquet PARTITIONED BY (fetched_date) "
              f"CLUSTERED BY (row_id) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def bucketed_exceptions(spark: SparkSession, batch: DataFrame, name: str) -> DataFrame:
    """``key_exceptions`` against a table of ``ensure_raw_table``.  A row id
    holds its fetch time, hence its day, so ids alone are joined: the stored
    side is read bucket by bucket, without an exchange."""
    stored = spark.table(name).where(F.col("fetched_date").isin(_days(batch, "fetched_date")))
    return key_exceptions(batch, stored, "row_id", "fetched_date", on=["row_id"])


def append_bucketed(spark: SparkSession, batch: DataFrame, name: str, gather: bool = False) -> dict:
    """SNK-2 into a bucketed table.  Each writing task makes one file per
    bucket (in small row groups, so that open files stay small); ``gather``
    shuffles the rows by bucket first, for large backfills."""
    columns = spark.table(name).columns
    rows = _without(batch.select(*columns), bucketed_exceptions(spark, batch.select(*columns), name), "row_id", "fetched_date")
    rows = require_not_null(rows, [c for c in columns if c != "fetched_date"])
    buckets = int(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])
    if gather:
        rows = rows.repartition(buckets, "row_id")
    obs = Observation("append")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("inserted"))
    with open_files(spark, buckets * OPEN_FILES):
        rows.select(*columns).write.option("parquet.block.size", 8 << 20).insertInto(name)
    return {"inserted": int(obs.get.get("inserted", 0))}


def write_if_any(df: DataFrame, write) -> bool:
    """SNK-11: run ``write(df)`` only when ``df`` has a row (a one-row probe,
    not a count)."""
    if df.isEmpty():
        return False
    write(df)
    return True


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SNK-6: view materialisation (lazy, re-evaluated on read)."""
    df.createOrReplaceTempView(name)
    return df


def as_catalog_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """SNK-6 across sessions: a catalog view from SQL text, re-evaluated on
    every read.  It may name catalog tables and views only; the catalog keeps
    the text and the settings (ANSI mode among them) it was made under."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def as_table(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """SNK-7: full rebuild of a table stored at ``path``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def write_partitioned(df: DataFrame, path: str, partition_col: str, cluster_by=(),
                      mode: str = "overwrite", dynamic: bool = True,
                      max_records_per_file: int = 5_000_000) -> None:
    """Partitioned parquet write without the small-files blow-up.

    Rows are range-partitioned on (partition, cluster keys) and sorted
    within each task: a task holds a contiguous slice of partitions, so the
    write makes about ``tasks + partitions`` files instead of ``tasks x
    partitions``, one large partition is still spread over several tasks,
    and sorted files carry tight min/max statistics for row-group skipping.
    ``dynamic`` replaces only the partitions present in ``df``.
    """
    keys = [partition_col, *cluster_by]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(partition_col).parquet(path)


def as_partitioned_table(spark: SparkSession, df: DataFrame, path: str,
                         partition_col: str = "day_utc", cluster_by=("city",),
                         max_records_per_file: int = 5_000_000) -> DataFrame:
    """SNK-8: day-partitioned table clustered by ``cluster_by``; late data
    rewrites only the days it touches (dynamic partition overwrite)."""
    write_partitioned(df, path, partition_col, cluster_by, "overwrite", True, max_records_per_file)
    return spark.read.parquet(path)


def load_summary(summary: dict, status: str = "success", **fields) -> dict:
    """SNK-10: ``{status, ..., inserted}`` for one load."""
    return {"status": status, **fields, **summary}
