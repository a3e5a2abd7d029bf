"""Whole-file JSON documents -> raw envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import basename, is_one_document, json_rewritten, now_or, strip_json_suffix


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """Every file matched by ``glob`` as one row ``(text, source)``.
    Small files are packed into one task by the file source; a file is
    never split (it is one document)."""
    # _metadata.file_path is a URI (spaces as %20): decode it, keeping '+'
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return (spark.read.text(glob, wholetext=True)
            .select(F.col("value").alias("text"), path.alias("source")))


def scan_json_files(spark: SparkSession, glob: str, fetched_at=None,
                    normalise: bool = False) -> DataFrame:
    """SRC-1: one raw envelope ``(raw_json, source, fetched_at)`` per file.

    The document text is kept as written (trimmed; keys keep their order,
    non-ASCII stays as is); ``normalise=True`` re-serialises it instead
    (``json_rewritten``: same keys in the same order, one spacing, no needless
    escapes).  Files that do not parse are kept with their text;
    ``split_valid`` separates them."""
    docs = read_documents(spark, glob)
    text = F.regexp_replace(F.col("text"), r"^\s+|\s+$", "")
    raw = F.coalesce(json_rewritten(text), text) if normalise else text
    return docs.select(raw.alias("raw_json"), "source", now_or(fetched_at).alias("fetched_at"))


def split_valid(df: DataFrame, col: str = "raw_json") -> tuple[DataFrame, DataFrame]:
    """SRC-2: (rows whose ``col`` holds exactly one JSON document, the rest).
    The bad part is a quarantine DataFrame: nothing stops the good part.
    Text after the document makes it bad."""
    ok = F.coalesce(is_one_document(col), F.lit(False))
    return df.where(ok), df.where(~ok)


def table_for(source_col: str = "source", prefix: str = "raw_") -> "F.Column":
    """SRC-3 + FN-23: target table name from the file's base name:
    ``prefix + basename(source).replace('.json', '')``."""
    return F.concat(F.lit(prefix), strip_json_suffix(basename(source_col)))


def scan_json_array(spark: SparkSession, glob: str, loaded_at=None) -> DataFrame:
    """SRC-4: JSON-array files -> one semi-raw customer row per object item
    (roots that are not arrays give nothing, non-object items are skipped,
    missing keys default to ``0`` / ``''``), stamped with ``loaded_at``."""
    from ..plans.customers import semi_raw_rows
    return semi_raw_rows(scan_json_files(spark, glob), loaded_at)
