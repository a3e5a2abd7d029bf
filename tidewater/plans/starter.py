"""The starter models: a literal relation holding a NULL and its child."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import where_equal
from ..sources.tables import literal_rows


def my_first_model(spark: SparkSession) -> DataFrame:
    """P-12: ``id`` = {1, NULL} (the NULL is on purpose: not_null fails)."""
    return literal_rows(spark)


def my_second_model(first: DataFrame) -> DataFrame:
    """P-12 child: ``where id = 1`` (the NULL drops)."""
    return where_equal(first, "id", 1)
