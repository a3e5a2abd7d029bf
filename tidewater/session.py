"""Session construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tidewater job relies on: UTC time, ANSI casts, AQE for
# runtime re-planning (partition coalescing, skew-join splitting).  Joins are
# never broadcast on a planner *estimate*; AQE broadcasts a side only after
# its shuffle stage has run and its real size is measured below the
# adaptive threshold.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # the last of equal keys wins, as in json.loads
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark, overrides=extra)
    return spark


def configure(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (driver-provided);
    ``overrides`` win over the defaults."""
    for k, v in {**SESSION_DEFAULTS, **(overrides or {})}.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return False


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and written intermediates.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only when it is unset and the master is local (tests)
    a private folder is created and registered as the checkpoint dir.
    """
    d = None
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        d = None
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:
            d = None
    if not d:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder."""
    base = shared_dir(spark)
    return f"{base}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


def ensure_local_dir(path: str) -> str:
    """Create ``path`` when it is a local filesystem path (no-op for URIs)."""
    p = path[len("file:"):] if path.startswith("file:") else path
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
    return path


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return int(total)


def size_for_input(spark: SparkSession, total_bytes: int, expansion: float = 4.0,
                   target_partition_bytes: int = 256 << 20, min_partitions: int | None = None) -> int:
    """Size the shuffle for an input of ``total_bytes`` on disk.

    Columnar, compressed input grows when parsed JSON documents are
    flattened into rows (``expansion``); the initial shuffle gets enough
    partitions for ``target_partition_bytes`` each and AQE coalesces the
    small ones at runtime, so one setting works from a laptop to a
    1000-executor cluster.  Returns the partition count it set.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(min_partitions or 2 * cores, -(-int(total_bytes * expansion) // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
