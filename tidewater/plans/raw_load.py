"""Raw loads: landing files and fetched weather documents -> append-only,
idempotent raw envelope tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import is_one_document, now_or
from ..sinks.tables import (append_idempotent, ensure_database, ensure_table, load_summary, new_rows, open_files,
                            require_not_null, with_row_id)
from ..sources.files import scan_json_files, split_valid, table_for
from ..sources.requests import DEFAULT_LOCATION, ingest_plan

RAW_FILE_COLUMNS = ["raw_json", "source", "fetched_at"]


def raw_file_rows(spark: SparkSession, glob: str, fetched_at=None,
                  prefix: str = "raw_") -> tuple[DataFrame, DataFrame]:
    """P-14 up to the write: scan, split off unparsable files (quarantine),
    route each good file to its table by base name."""
    env = scan_json_files(spark, glob, fetched_at)
    good, bad = split_valid(env)
    good = good.withColumn("table_name", table_for("source", prefix))
    return require_not_null(good, RAW_FILE_COLUMNS), bad


def run_time(spark: SparkSession, fetched_at=None) -> str:
    """``fetched_at``, or the current time as one literal: a load plans more
    than one job, and all of them must stamp its rows alike."""
    stamp = F.current_timestamp() if fetched_at is None else F.lit(fetched_at).cast("timestamp")
    return spark.range(1).select(stamp.cast("string")).first()[0]


def load_raw_files(spark: SparkSession, glob: str, target: str, fetched_at=None,
                   prefix: str = "raw_", normalise: bool = False) -> dict:
    """P-14: append the landed files to the raw store at ``target``
    (partitioned by fetch day; ``table_name`` names each row's table).
    Returns the load summary; bad files are counted, not loaded.  The write
    counts both kinds itself.  ``normalise`` as in ``scan_json_files``."""
    env = scan_json_files(spark, glob, run_time(spark, fetched_at), normalise)
    rows = with_row_id(require_not_null(env.withColumn("table_name", table_for("source", prefix)), RAW_FILE_COLUMNS), "source")
    rows = new_rows(spark, rows.withColumn("_bad", ~is_one_document("raw_json")), target)
    seen = Observation("files")
    rows = rows.observe(seen, F.count_if(~F.col("_bad")).alias("inserted"), F.count_if("_bad").alias("skipped"))
    with open_files(spark):
        rows.where(~F.col("_bad")).drop("_bad").write.mode("append").partitionBy("fetched_date").parquet(target)
    counts = {k: int(seen.get.get(k) or 0) for k in ("inserted", "skipped")}
    if not any(counts.values()) and env.isEmpty():
        return load_summary(counts, status="no_files")
    return load_summary(counts)


RAW_TABLE_DDL = "raw_json STRING NOT NULL, source STRING NOT NULL, fetched_at TIMESTAMP NOT NULL, row_id STRING NOT NULL, fetched_date DATE"
QUARANTINE = "quarantine"


def routed_rows(spark: SparkSession, glob: str, fetched_at=None, prefix: str = "raw_",
                normalise: bool = False) -> DataFrame:
    """P-14 up to the write, in one pass over the files: every file with its
    target table by base name; files that are not one JSON document go to the
    ``quarantine`` table.  NULLs in REQUIRED columns fail."""
    env = with_row_id(scan_json_files(spark, glob, fetched_at, normalise), "source")
    # The catalog takes letters, digits and _ in a name, in any case.
    name = F.regexp_replace(F.lower(table_for("source", prefix)), "[^a-z0-9_]", "_")
    table = F.when(is_one_document("raw_json"), name).otherwise(F.lit(QUARANTINE))
    return require_not_null(env.withColumn("table_name", table), RAW_FILE_COLUMNS)


def load_routed(spark: SparkSession, glob: str, root: str, database: str, fetched_at=None,
                prefix: str = "raw_", location: str | None = None, normalise: bool = False) -> dict:
    """P-14 with its tables: one write partitioned by table and day, whose
    folders are the catalog tables ``database.<prefix><base name>`` (REQUIRED
    columns, created if absent) and ``database.quarantine``.

    A retry inserts nothing.  Returns the load summary with an error status
    instead of raising: ``status`` (success, no_files, error), ``date``,
    ``location``, ``database``, ``inserted`` and ``skipped`` (quarantined),
    both counted by the write itself.  ``normalise`` as in ``scan_json_files``."""
    fetched_at = run_time(spark, fetched_at)
    fields = {"location": location or glob, "date": fetched_at[:10], "database": database}
    try:
        rows = routed_rows(spark, glob, fetched_at, prefix, normalise)
        fresh = new_rows(spark, rows, root)
        seen = Observation("routed")
        bad = F.col("table_name") == QUARANTINE
        fresh = fresh.observe(seen, F.count_if(~bad).alias("inserted"), F.count_if(bad).alias("skipped"))
        with open_files(spark):
            fresh.write.mode("append").partitionBy("table_name", "fetched_date").parquet(root)
        register_routed(spark, root, database)
        counts = {k: int(seen.get.get(k) or 0) for k in ("inserted", "skipped")}
        return load_summary(counts, **fields)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return load_summary({"inserted": 0, "skipped": 0}, status="no_files", **fields)
    except (Py4JJavaError, CapturedException) as problem:
        return load_summary({"inserted": 0, "skipped": 0}, status="error", error=str(problem).split("\n")[0], **fields)


def register_routed(spark: SparkSession, root: str, database: str) -> list[str]:
    """Create the tables of the folders below ``root`` where absent and
    register their new days (metadata only); returns the table names."""
    ensure_database(spark, database, f"{root}_db")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = []
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/table_name=*")) or []:
        name = st.getPath().getName().split("=", 1)[1]
        ensure_table(spark, f"{database}.{name}", RAW_TABLE_DDL, st.getPath().toString(), partitioned_by="fetched_date")
        spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
        names.append(name)
    return names


def weather_envelopes_from_requests(requests: DataFrame, payload_col: str = "payload",
                                    fetched_at=None, default_location=None,
                                    default_date=None, as_of=None) -> DataFrame:
    """P-15 up to the write: resolve the request parameters, build the
    secret-free source URL, wrap the landed payload as an envelope."""
    plan = ingest_plan(requests, default_location=default_location or DEFAULT_LOCATION,
                       default_date=default_date, as_of=as_of)
    # a request for a further part of a day has a source url of its own
    url = F.col("source_url")
    if "part" in requests.columns:
        url = F.when(F.col("part") > 0, F.concat(url, F.lit("&part="), F.col("part").cast("string"))).otherwise(url)
    return plan.select(F.col(payload_col).alias("raw_json"), url.alias("source_url"),
                       now_or(fetched_at).alias("fetched_at"),
                       F.col("resolved_location").alias("location"),
                       F.col("resolved_date").alias("date"))


def load_weather(spark: SparkSession, requests: DataFrame, target: str, fetched_at=None,
                 payload_col: str = "payload") -> dict:
    """P-15: landed weather documents -> idempotent append -> summary."""
    env = weather_envelopes_from_requests(requests, payload_col, run_time(spark, fetched_at))
    rows = with_row_id(env.select("raw_json", "source_url", "fetched_at"), "source_url")
    res = append_idempotent(spark, rows, target)
    return load_summary(res, table=target)
