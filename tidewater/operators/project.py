"""Projections: renames, struct fields, computed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """PRJ-3."""
    return df.withColumnsRenamed(mapping)


def struct_fields(df: DataFrame, struct_col: str, fields, keep=()) -> DataFrame:
    """PRJ-4: ``s.f AS f`` for each field (nested pruning keeps the scan to
    the fields used)."""
    return df.select(*keep, *[F.col(f"{struct_col}.{f}").alias(f) for f in fields])


def with_product(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """PRJ-5: ``a * b AS name``."""
    return df.withColumn(name, F.col(a) * F.col(b))


def except_columns(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ-2: ``SELECT * EXCEPT(cols)``."""
    return df.drop(*cols)
