"""Producer -> consumer: signed greeting records written as JSON objects."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sinks.records import record_keys, write_records
from ..sources.requests import produce_records


def produce(requests: DataFrame, secret: str, name_col: str = "name", produced_at=None,
            default_name: str = "Student") -> DataFrame:
    """P-13 producer step."""
    return produce_records(requests, secret, name_col=name_col, default_name=default_name,
                           produced_at=produced_at)


def produce_and_key(requests: DataFrame, secret: str, folder: str = "exercise/",
                    at=None, name_col: str = "name") -> DataFrame:
    """P-13 without the write: records with their object key."""
    return record_keys(produce(requests, secret, name_col, at), folder, at)


def produce_and_write(requests: DataFrame, secret: str, root: str, folder: str = "exercise/",
                      at=None, name_col: str = "name") -> DataFrame:
    """P-13: produce, then write one JSON record per message."""
    return write_records(produce(requests, secret, name_col, at), root, folder, at)
