"""Declared tables, literal relations and projections of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source(spark: SparkSession, name: str, root: str | None = None, fmt: str = "parquet") -> DataFrame:
    """SRC-5 / SRC-7: a declared source: a catalog table, or ``root/name``
    read with ``fmt`` (nested columns are pruned by the scan)."""
    if root is None:
        return spark.table(name)
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")


def literal_rows(spark: SparkSession) -> DataFrame:
    """SRC-8 + SET-1: ``select 1 as id union all select null as id``."""
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def single_column(df: DataFrame, col: str = "raw_json") -> DataFrame:
    """SRC-9: read one column only (the scan's ReadSchema holds just it)."""
    return df.select(col)
