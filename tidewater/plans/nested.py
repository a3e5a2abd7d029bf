"""Typed nested tables and JSON-column tables flattened to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import document_objects, json_query_array, json_value, strict_cast
from ..operators import unnest


def stg_orders_items(orders: DataFrame) -> DataFrame:
    """P-9: one row per order item (orders without items vanish)."""
    x = unnest(orders, "items", "item", keep=["order_id", "customer_id", "order_date"])
    return x.select(
        "order_id", "customer_id",
        strict_cast("order_date", "timestamp").alias("order_ts"),
        F.col("item.product_id").alias("product_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.unit_price").alias("unit_price"),
        (F.col("item.quantity") * F.col("item.unit_price")).alias("line_amount"))


def stg_playlists_tracks(playlists: DataFrame) -> DataFrame:
    """P-10: one row per track of a playlist."""
    x = unnest(playlists, "tracks", "track", keep=["playlist_id", "owner_id", "title"])
    return x.select(
        "playlist_id", "owner_id", F.col("title").alias("playlist_title"),
        F.col("track.track_id").alias("track_id"),
        F.col("track.title").alias("track_title"),
        F.col("track.duration_sec").alias("duration_sec"))


def fct_tracks(playlists: DataFrame) -> DataFrame:
    """P-10 fact: pass-through of the staging rows (PRJ-1)."""
    return stg_playlists_tracks(playlists)


def stg_sessions_events(sessions_json: DataFrame, raw_col: str = "raw") -> DataFrame:
    """P-11: JSON column ``raw`` holding user documents (or arrays of them)
    -> one row per (user, session, event).  Parsed once; the user id is
    read before the session unnest, the session id before the event unnest."""
    docs = sessions_json.select(F.explode(document_objects(raw_col)).alias("u"))
    users = docs.select(strict_cast(json_value("u", "$.user_id"), "bigint").alias("user_id"),
                        json_query_array("u", "$.sessions").alias("sessions"))
    sessions = users.select("user_id", F.explode("sessions").alias("s"))
    events = sessions.select("user_id", json_value("s", "$.session_id").alias("session_id"),
                             F.explode(json_query_array("s", "$.events")).alias("e"))
    return events.select(
        "user_id", "session_id",
        json_value("e", "$.event_type").alias("event_type"),
        strict_cast(json_value("e", "$.ts"), "timestamp").alias("event_ts"))


def fct_sessions_events(sessions_json: DataFrame) -> DataFrame:
    """P-11 fact: pass-through (PRJ-1)."""
    return stg_sessions_events(sessions_json)
