"""Golden tests on four small invented documents."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import ColumnTest, run_suite
from tidewater.plans import customers as cu
from tidewater.plans import nested, starter
from tidewater.session import scratch_path, ensure_local_dir
from tidewater.sources.files import scan_json_files

CUSTOMERS = [
    {"id": 11, "name": "MIRA o'dell", "email": "Mira@Example.org", "signup_date": "2023-03-01"},
    {"id": 12, "name": "teo brandt", "email": "teo@example.org", "signup_date": "2023-03-01"},
    {"id": 13, "name": "Ida Quist", "email": "ida@example.net", "signup_date": "2023-03-09"},
]
ORDERS = [
    {"order_id": "A7", "customer_id": 12, "order_date": "2023-04-02T08:30:00Z",
     "items": [{"product_id": "lamp", "quantity": 3, "unit_price": 12.5}]},
    {"order_id": "A8", "customer_id": 11, "order_date": "2023-04-03T19:05:10Z",
     "items": [{"product_id": "chair", "quantity": 1, "unit_price": 80.0},
               {"product_id": "rug", "quantity": 2, "unit_price": 45.25}]},
]
PLAYLISTS = [
    {"playlist_id": "night", "owner_id": 13, "title": "Late trains",
     "tracks": [{"track_id": "k1", "title": "Signal box", "duration_sec": 301},
                {"track_id": "k2", "title": "Platform nine", "duration_sec": 122}]},
    {"playlist_id": "none", "owner_id": 12, "title": "Still empty", "tracks": []},
]
SESSIONS = [
    {"user_id": 13, "sessions": [
        {"session_id": "x1", "events": [{"event_type": "open", "ts": "2023-05-01T07:00:00Z"}]},
        {"session_id": "x2", "events": [{"event_type": "open", "ts": "2023-05-02T07:00:00Z"},
                                        {"event_type": "close", "ts": "2023-05-02T07:45:30Z"}]}]},
    {"user_id": 11, "sessions": []},
]


@pytest.fixture(scope="module")
def landing(spark):
    root = ensure_local_dir(scratch_path(spark, "samples"))
    p = root[len("file:"):] if root.startswith("file:") else root
    for name, data in [("customers", CUSTOMERS), ("orders", ORDERS), ("playlists", PLAYLISTS),
                       ("sessions", SESSIONS)]:
        with open(f"{p}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(data, f, indent=2, ensure_ascii=False)
    return root


def _env(spark, landing, name):
    return scan_json_files(spark, f"{landing}/{name}.json", "2025-09-01 00:00:00")


def test_orders_items_line_amounts(spark, landing):
    schema = ("order_id string, customer_id bigint, order_date string, "
              "items array<struct<product_id:string,quantity:bigint,unit_price:double>>")
    orders = spark.read.schema(schema).json(f"{landing}/orders.json", multiLine=True)
    rows = nested.stg_orders_items(orders).orderBy("order_id", "product_id").collect()
    assert [round(r.line_amount, 6) for r in rows] == [37.5, 80.0, 90.5]
    assert rows[0].order_ts.isoformat() == "2023-04-02T08:30:00"


def test_playlists_tracks(spark, landing):
    schema = ("playlist_id string, owner_id bigint, title string, "
              "tracks array<struct<track_id:string,title:string,duration_sec:bigint>>")
    p = spark.read.schema(schema).json(f"{landing}/playlists.json", multiLine=True)
    rows = nested.fct_tracks(p).orderBy("track_id").collect()
    assert [r.track_id for r in rows] == ["k1", "k2"]
    assert rows[1].playlist_title == "Late trains" and rows[1].duration_sec == 122


def test_sessions_events_root_array(spark, landing):
    raw = _env(spark, landing, "sessions").select(F.col("raw_json").alias("raw"))
    rows = nested.stg_sessions_events(raw).orderBy("event_ts").collect()
    assert [(r.user_id, r.session_id, r.event_type) for r in rows] == [
        (13, "x1", "open"), (13, "x2", "open"), (13, "x2", "close")]


def test_customers_strict_and_signups(spark, landing):
    env = _env(spark, landing, "customers")
    c = cu.stg_customers(env)
    got = {r.customer_id: (r.customer_name, r.email, str(r.signup_date)) for r in c.collect()}
    assert got[11] == ("Mira O'dell", "mira@example.org", "2023-03-01")
    days = cu.int_customer_signups(c).orderBy("signup_date").collect()   # ordered at read
    assert [(str(r.signup_date), r.daily_signups) for r in days] == [("2023-03-01", 2), ("2023-03-09", 1)]


def test_tolerant_equals_pandas_model(spark, landing):
    env = _env(spark, landing, "customers")
    native = sorted(tuple(r) for r in cu.stg_customers_tolerant(env).collect())
    pandas = sorted(tuple(r) for r in cu.stg_customers_tolerant_pandas(env).collect())
    assert native == pandas and len(native) == 3


def test_schema_tests_on_samples(spark, landing):
    c = cu.stg_customers(_env(spark, landing, "customers"))
    first = starter.my_first_model(spark)
    emails = [x["email"].lower() for x in CUSTOMERS]
    rep = run_suite({"stg_customers": c, "first": first, "second": starter.my_second_model(first)}, [
        ColumnTest("stg_customers", "customer_id", "not_null"),
        ColumnTest("stg_customers", "customer_id", "unique"),
        ColumnTest("stg_customers", "email", "accepted_values", emails),
        ColumnTest("first", "id", "not_null"),
        ColumnTest("second", "id", "not_null"),
    ]).collect()
    status = {(r.model, r.column_name, r.test): (r.failures, r.status) for r in rep}
    assert status[("stg_customers", "email", "accepted_values")] == (0, "pass")
    assert status[("first", "id", "not_null")] == (1, "fail")      # the NULL on purpose
    assert status[("second", "id", "not_null")] == (0, "pass")


DIRTY = ['[{"id":"9007199254740993","name":"a"},{"id":"12d"},{"id":"1e3","signup_date":"2024-01-05"},{"id":-2.9}]', "{broken", None,
         '[{"id":7,"name":"x","name":"y","signup_date":"soon"}, 5, null]', '{"id":" 8 ","email":"UP@X.org"}', "[NaN]", '"text"']


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_tolerant_forms_agree_however_documents_fall(spark, partitions):
    raw = spark.createDataFrame([(t,) for t in DIRTY], "raw_json string").repartition(partitions)
    native = sorted(map(repr, cu.stg_customers_tolerant(raw).collect()))
    assert native == sorted(map(repr, cu.stg_customers_tolerant_pandas(raw).collect()))
    ids = sorted(r.customer_id for r in cu.stg_customers_tolerant(raw).collect())
    assert ids == [-2, 7, 8, 1000, 9007199254740993]
    assert {r.customer_name for r in cu.stg_customers_tolerant(raw).collect()} >= {"A", "Y"}


def test_missing_key_is_not_json_null(spark):
    raw = spark.createDataFrame([('[{"id":1,"name":null},{"name":""},{"id":null,"email":"E"},{"id":12.7}]',)], "raw_json string")
    rows = [(r.customer_id, r.name, r.email) for r in cu.semi_raw_rows(raw.limit(1).select(F.regexp_replace("raw_json", "12.7", "12").alias("raw_json"))).collect()]
    assert rows == [(1, None, ""), (0, "", ""), (None, "", "E"), (12, "", "")]
    whole = spark.createDataFrame([('[{"id":12.7,"signup_date":"2024-01-01"},{"signup_date":"2024-01-01"}]',)], "raw_json string")
    assert [r.customer_id for r in cu.transformed_customers(whole).collect()] == [12, 0]
    with pytest.raises(Exception, match="no integer"):
        cu.transformed_customers(raw).collect()


@pytest.mark.parametrize("text, good", [('{"a":1}', True), (" [1] ", True), ("5", True), ('{"a":1} oops', False), ("[1] ]", False), ('{"a":1} }', False),
                                        ("1,2", False), ('1,"b":2', False), ("1],[2", False), ('{"a":1,"a":2}', True), ("", False), (None, False)])
def test_whole_text_is_one_document(spark, text, good):
    from tidewater.sources.files import split_valid
    kept, bad = split_valid(spark.createDataFrame([(text,)], "raw_json string"))
    assert (kept.count(), bad.count()) == ((1, 0) if good else (0, 1))
