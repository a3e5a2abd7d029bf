"""Data-quality queries: each test returns its failing rows; the suite
reproduces the reference's column tests on the staged fixture models."""

from __future__ import annotations

from .. import fixtures as fx
from ..operators import ColumnTest, accepted_values, not_null, run_suite, tested_write, unique
from ..plans import customers as cu
from ..plans import nested, starter
from ..session import configure, scratch_path
from .customers import customers_tolerant
from .registry import oracles, register
from .sqlfrag import CUSTOMER_OBJECTS

# The accepted e-mail addresses of the reference's column test.
ACCEPTED_EMAILS = ["ava.nilsson@example.com", "noah.andersson@example.com",
                   "elsa.j@example.com", "liam.karlsson@example.com"]
# The accepted event types used by the events check.
ACCEPTED_EVENT_TYPES = ["click", "view", "purchase"]


def _t(spark, sf_dir, name):
    configure(spark)
    return fx.read_table(spark, sf_dir, name)


@register("dq_not_null", f"SELECT * FROM ({oracles()['customers_tolerant']}) WHERE signup_date IS NULL")
def dq_not_null(spark, sf_dir):
    """DQ-1: rows of the tolerant customers with no signup date."""
    return not_null(customers_tolerant(spark, sf_dir), "signup_date")


@register("dq_unique", """
SELECT user_id, count(*) AS n_records FROM events WHERE user_id IS NOT NULL
GROUP BY user_id HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    """DQ-2: duplicated values (NULLs not counted)."""
    return unique(_t(spark, sf_dir, "events"), "user_id")


@register("dq_accepted_values", f"""
SELECT event_type, count(*) AS n_records FROM events
WHERE event_type IS NOT NULL AND event_type NOT IN ({", ".join(repr(v) for v in ACCEPTED_EVENT_TYPES)})
GROUP BY event_type""")
def dq_accepted_values(spark, sf_dir):
    """DQ-3: values outside the accepted list, with counts."""
    return accepted_values(_t(spark, sf_dir, "events"), "event_type", ACCEPTED_EVENT_TYPES)


SUITE = [
    ColumnTest("stg_customers", "customer_id", "not_null"),
    ColumnTest("stg_customers", "customer_id", "unique"),
    ColumnTest("stg_customers", "email", "not_null"),
    ColumnTest("stg_customers", "email", "accepted_values", ACCEPTED_EMAILS),
    ColumnTest("stg_orders_items", "order_id", "not_null"),
    ColumnTest("stg_orders_items", "product_id", "not_null"),
    ColumnTest("stg_sessions_events", "user_id", "not_null"),
    ColumnTest("stg_sessions_events", "event_type", "not_null"),
    ColumnTest("stg_playlists_tracks", "playlist_id", "not_null"),
    ColumnTest("stg_playlists_tracks", "track_id", "not_null"),
    ColumnTest("my_first_model", "id", "unique"),
    ColumnTest("my_first_model", "id", "not_null"),
    ColumnTest("my_second_model", "id", "unique"),
    ColumnTest("my_second_model", "id", "not_null"),
]


def _suite_sql():
    emails = ", ".join(repr(v) for v in ACCEPTED_EMAILS)
    rows = [
        ("stg_customers", "customer_id", "not_null", "0"),
        ("stg_customers", "customer_id", "unique",
         "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1))"),
        ("stg_customers", "email", "not_null", "0"),
        ("stg_customers", "email", "accepted_values",
         f"(SELECT count(*) FROM ({CUSTOMER_OBJECTS}) WHERE lower(email) NOT IN ({emails}))"),
        ("stg_orders_items", "order_id", "not_null", "0"),
        ("stg_orders_items", "product_id", "not_null", "0"),
        ("stg_sessions_events", "user_id", "not_null", "0"),
        ("stg_sessions_events", "event_type", "not_null", "0"),
        ("stg_playlists_tracks", "playlist_id", "not_null", "0"),
        ("stg_playlists_tracks", "track_id", "not_null", "0"),
        ("my_first_model", "id", "unique", "0"),
        ("my_first_model", "id", "not_null", "1"),
        ("my_second_model", "id", "unique", "0"),
        ("my_second_model", "id", "not_null", "0"),
    ]
    parts = [f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, CAST({f} AS BIGINT) AS failures"
             for m, c, t, f in rows]
    body = "\nUNION ALL ".join(parts)
    return f"""
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
{body})"""


@register("dq_report", _suite_sql())
def dq_report(spark, sf_dir):
    """DQ-4: the column tests of the reference's model schemas, run on the
    staged fixture models (the starter model's NULL id fails on purpose)."""
    t = lambda n: _t(spark, sf_dir, n)
    first = starter.my_first_model(spark)
    models = {
        "stg_customers": cu.stg_customers(fx.customer_documents(t("customer"))),
        "stg_orders_items": nested.stg_orders_items(fx.orders_nested(t("orders"), t("lineitem"))),
        "stg_sessions_events": nested.stg_sessions_events(fx.sessions_documents(t("events"))),
        "stg_playlists_tracks": nested.stg_playlists_tracks(
            fx.playlists_nested(t("supplier"), t("lineitem"), t("part"))),
        "my_first_model": first,
        "my_second_model": starter.my_second_model(first),
    }
    return run_suite(models, SUITE)


_EVENT_TESTS = [ColumnTest("events", "event_type", "accepted_values", ACCEPTED_EVENT_TYPES), ColumnTest("events", "event_type", "not_null"),
                ColumnTest("events", "user_id", "unique"), ColumnTest("events", "event_id", "unique")]


def _event_tests_sql():
    values = ", ".join(repr(v) for v in ACCEPTED_EVENT_TYPES)
    repeated = "coalesce((SELECT sum(n) FROM (SELECT count(*) AS n FROM events WHERE {0} IS NOT NULL GROUP BY {0} HAVING count(*) > 1)), 0)"
    rows = [("event_type", "accepted_values", f"(SELECT count(*) FROM events WHERE event_type NOT IN ({values}))"),
            ("event_type", "not_null", "(SELECT count(*) FROM events WHERE event_type IS NULL)"),
            ("user_id", "unique", repeated.format("user_id")), ("event_id", "unique", repeated.format("event_id"))]
    body = " UNION ALL ".join(f"SELECT 'events' AS model, '{c}' AS column_name, '{t}' AS test, CAST({n} AS BIGINT) AS failures" for c, t, n in rows)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})"


@register("dq_during_write", _event_tests_sql())
def dq_during_write(spark, sf_dir):
    """DQ-1..4 with row-level tests counted by the write of the model."""
    events = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return tested_write(events, "events", _EVENT_TESTS, scratch_path(spark, "tested-events"))


@register("native_python_model", oracles()["customers_tolerant"])
def native_python_model(spark, sf_dir):
    """UDF-1 / UDF-2: the tolerant customer model as a mapInPandas model;
    equals the native column version."""
    return cu.stg_customers_tolerant_pandas(fx.customer_documents_dirty(_t(spark, sf_dir, "customer")))
