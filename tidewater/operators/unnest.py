"""Lateral unnest of arrays (inner semantics: NULL/empty arrays drop the row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import (NOT_ONE_DOCUMENT, document_objects, is_one_document, json_kind, json_query_array,
                              rejected_items, root_items, text_kind)


ColumnOrName = Column | str


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def unnest(df: DataFrame, array_col: str, alias: str, keep: list | None = None) -> DataFrame:
    """LAT-1: one row per element of an ARRAY column (``FROM t, UNNEST(a)``)."""
    keep = [c for c in df.columns if c != array_col] if keep is None else keep
    return df.select(*keep, F.explode(_c(array_col)).alias(alias))


def unnest_path(df: DataFrame, doc: str | Column, path: str, alias: str,
                keep: list | None = None) -> DataFrame:
    """LAT-2/3/4: one row per item of the JSON array at ``path`` of a VARIANT
    column; a missing or non-array value drops the row."""
    keep = list(df.columns) if keep is None else keep
    return df.select(*keep, F.explode(json_query_array(doc, path)).alias(alias))


def keep_objects(df: DataFrame, item: str) -> DataFrame:
    """FLT-5: keep rows whose VARIANT ``item`` is a JSON object."""
    return df.where(json_kind(item) == "OBJECT")


def keep_array_roots(df: DataFrame, doc: str, text: str | None = None) -> DataFrame:
    """FLT-6: keep documents whose root is a JSON array (decided from the
    document text when it is given, else from the VARIANT)."""
    kind = text_kind(text) if text is not None else json_kind(doc)
    return df.where(F.col(doc).isNotNull() & (kind == "ARRAY"))


def explode_tolerant(df: DataFrame, text_col: str = "raw_json", alias: str = "obj",
                     keep: list | None = None) -> DataFrame:
    """LAT-5: tolerant document explode.  NULL or unparsable text -> no rows;
    array -> its object items; a single object -> one row; other -> none.
    Arrays are read item by item, whatever their size."""
    keep = [] if keep is None else keep
    out = df.select(*keep, F.explode(document_objects(text_col)).alias(alias))
    return keep_objects(out, alias)


def quarantine(df: DataFrame, text_col: str = "raw_json", keep: list | None = None) -> DataFrame:
    """What ``explode_tolerant`` leaves out for its form: one row per rejected
    document (item NULL) or item, with its size and the reason."""
    keep = [] if keep is None else keep
    out = df.select(*keep, F.explode(rejected_items(text_col)).alias("__r"))
    return out.select(*keep, "__r.item", "__r.bytes", "__r.reason")


def explode_strict(df: DataFrame, text_col: str = "raw_json", alias: str = "obj",
                   keep: list | None = None) -> DataFrame:
    """LAT-6: strict explode: text that is not one JSON document fails the
    query, and so does an item that exceeds a VARIANT; a root that is not an
    array is skipped, non-object items are skipped."""
    keep = [] if keep is None else keep
    t = F.col(text_col)
    fail = F.raise_error(F.lit(NOT_ONE_DOCUMENT)).cast("array<variant>")
    items = (F.when(t.isNull(), F.lit(None).cast("array<variant>"))
             .when(text_kind(t) == "ARRAY", F.coalesce(root_items(t), fail))
             .when(~is_one_document(t), fail))
    return keep_objects(df.select(*keep, F.explode(items).alias(alias)), alias)
