"""Declarative data-quality tests.  Each test is a query that returns the
failing rows (or values); a suite turns them into one report DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ-1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """DQ-2: values of ``col`` seen more than once (NULLs not counted), with
    their count.  Partial aggregation runs before the shuffle."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """DQ-3: values outside ``values`` (NULL is not tested), with counts."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records")))


@dataclass
class ColumnTest:
    model: str
    column: str
    test: str                     # not_null | unique | accepted_values
    values: list = field(default_factory=list)


def failures(df: DataFrame, t: ColumnTest) -> DataFrame:
    if t.test == "not_null":
        return not_null(df, t.column)
    if t.test == "unique":
        return unique(df, t.column)
    if t.test == "accepted_values":
        return accepted_values(df, t.column, t.values)
    raise ValueError(f"unknown test {t.test}")


def _failing(t: ColumnTest):
    """Row-level failure predicate of a not_null / accepted_values test."""
    c = F.col(t.column)
    if t.test == "not_null":
        return c.isNull()
    return c.isNotNull() & ~c.isin(list(t.values))


def run_suite(models: dict, tests: list) -> DataFrame:
    """DQ-4: one row per (model, column, test) with the number of failing
    records (for ``unique``/``accepted_values``: the rows carrying a failing
    value) and a pass/fail status.

    One scan per model answers all its tests: every row yields one (test,
    value) pair per test (the column's value for ``unique``, a mark for a row
    that fails a row-level test), pairs are counted with partial aggregation,
    and the counts add up per test.
    """
    by_model: dict = {}
    for i, t in enumerate(tests):
        if t.test not in ("not_null", "accepted_values", "unique"):
            raise ValueError(f"unknown test {t.test}")
        by_model.setdefault(t.model, []).append((i, t))

    def cell(i, t):
        value = F.col(t.column).cast("string") if t.test == "unique" else F.when(_failing(t), F.lit("fails"))
        return F.struct(F.lit(i).alias("idx"), F.lit(t.test == "unique").alias("once"), value.alias("value"))

    out = None
    for model, items in by_model.items():
        cells = models[model].select(F.explode(F.array(*[cell(i, t) for i, t in items])).alias("c"))
        counts = cells.where("c.value is not null").groupBy("c.idx", "c.once", "c.value").agg(F.count(F.lit(1)).alias("n"))
        part = counts.groupBy("idx").agg(F.sum(F.when(F.col("once") & (F.col("n") == 1), 0).otherwise(F.col("n"))).alias("failures"))
        out = part if out is None else out.unionByName(part)
    spark = out.sparkSession if out is not None else SparkSession.active()
    if out is None:  # no tests: an empty report
        out = spark.createDataFrame([], "idx int, failures bigint")
    meta = spark.createDataFrame([(i, t.model, t.column, t.test) for i, t in enumerate(tests)],
                                 "idx int, model string, column_name string, test string")
    # one row per declared test with a failure
    res = meta.join(F.broadcast(out), "idx", "left").withColumn("failures", F.coalesce("failures", F.lit(0)).cast("bigint"))
    return res.select("model", "column_name", "test", "failures",
                      F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def tested_write(df: DataFrame, model: str, tests: list, path: str) -> DataFrame:
    """DQ-4 while a model is written: ``run_suite``'s report of the tests of
    ``model``, with ``df`` materialised as Parquet at ``path``.

    Row-level tests are metrics observed by the write itself, so they cost no
    scan.  ``unique`` tests read their own columns of the written files.  The
    model is written whatever the tests say, like a warehouse model that is
    tested after its build."""
    rows = [(i, t) for i, t in enumerate(tests) if t.model == model and t.test in ("not_null", "accepted_values")]
    seen = Observation("tests")
    if rows:
        df = df.observe(seen, *[F.count_if(_failing(t)).alias(f"t{i}") for i, t in rows])
    df.write.mode("overwrite").parquet(path)
    # an empty input may leave the metrics unset
    counts = [(t.model, t.column, t.test, int(seen.get.get(f"t{i}") or 0)) for i, t in rows] if rows else []
    spark = df.sparkSession
    report = spark.createDataFrame([(*c, "pass" if c[-1] == 0 else "fail") for c in counts],
                                   "model string, column_name string, test string, failures bigint, status string")
    others = [t for t in tests if t.model == model and t.test not in ("not_null", "accepted_values")]
    return report.unionByName(run_suite({model: spark.read.parquet(path)}, others)) if others else report
