"""Nested tables (orders, playlists) and the sessions JSON column."""

from __future__ import annotations

from .. import fixtures as fx
from ..plans import nested
from ..session import configure
from .registry import register


def _t(spark, sf_dir, name):
    configure(spark)
    return fx.read_table(spark, sf_dir, name)


ORDERS_ITEMS_SQL = """
SELECT 'o-' || CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
       CAST(o_orderdate AS TIMESTAMP) AS order_ts, 'p-' || CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS unit_price,
       CAST(l_quantity AS BIGINT) * l_extendedprice AS line_amount
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""


@register("orders_items", ORDERS_ITEMS_SQL)
def orders_items(spark, sf_dir):
    """P-9 over orders packed with their line items."""
    o = fx.orders_nested(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    return nested.stg_orders_items(o)


PLAYLIST_SQL = """
SELECT 'pl-' || CAST(s_suppkey AS VARCHAR) AS playlist_id, CAST(s_nationkey AS BIGINT) AS owner_id,
       s_name AS playlist_title,
       't-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS track_id,
       p_name AS track_title, CAST(l_quantity * 10 AS BIGINT) AS duration_sec
FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey
"""


@register("playlist_tracks", PLAYLIST_SQL)
def playlist_tracks(spark, sf_dir):
    """P-10: suppliers packed as playlists of their line items -> fct_tracks."""
    p = fx.playlists_nested(_t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "lineitem"),
                            _t(spark, sf_dir, "part"))
    return nested.fct_tracks(p)


SESSIONS_SQL = """
SELECT user_id, 's-' || CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS session_id,
       event_type, CAST(ts AS TIMESTAMP) AS event_ts
FROM events
"""


@register("sessions_events", SESSIONS_SQL)
def sessions_events(spark, sf_dir):
    """P-11: user documents (some wrapped in arrays) -> events."""
    return nested.fct_sessions_events(fx.sessions_documents(_t(spark, sf_dir, "events")))
