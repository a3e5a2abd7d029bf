"""One parse rule for every path, and arrays larger than a VARIANT."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidewater import functions as fn
from tidewater.functions.json import parse_shape
from tidewater.operators import explode_strict, explode_tolerant, quarantine
from tidewater.plans import customers, nested, weather

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
GOOD = ["[]", ' [ {"id": 1} ] ', '{"id": 1}', "null", "1", '"x"', '[{"id":1},7,"s",null,[2]]', '{"a":1,"a":2}', '["[]", "1], [1"]']
BAD = ["", "  ", '[{"id":1}] oops', '{"id":1} {"id":2}', "[1]] [1]", "[1],[2]", "1, 2", "1] 2", '{"id":1}//c', "[1,]", "{'id':1}", "[NaN]", "[01]", '[{"id":1}', "], [", '"a" "b"', "1 1"]


def _texts(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_json string")


def test_every_parse_takes_whole_documents_only(spark):
    df = _texts(spark, GOOD + BAD)
    rows = df.select("raw_json", fn.safe_parse("raw_json").isNotNull().alias("safe"), fn.is_one_document("raw_json").alias("one"),
                     fn.root_items("raw_json").isNotNull().alias("items"), parse_shape("raw_json", "id variant").isNotNull().alias("shape")).collect()
    for r in rows:
        good = r.raw_json in GOOD
        root = json.loads(r.raw_json) if good else None
        assert (r.safe, r.one, r["items"], r["shape"]) == (good, good, isinstance(root, list), isinstance(root, dict)), r


@pytest.mark.parametrize("bad", ['[{"id":1}] oops', "[1,"])
def test_strict_paths_refuse_what_tolerant_ones_skip(spark, bad):
    df = _texts(spark, ['[{"id":1},3]', bad])
    assert explode_tolerant(df).count() == 1
    with pytest.raises(Exception, match="not one JSON document"):
        explode_strict(df).collect()
    with pytest.raises(Exception, match="not one JSON document"):
        df.select(fn.strict_parse("raw_json").cast("string")).collect()


def test_native_model_equals_the_python_model_on_every_form(spark):
    forms = GOOD + BAD + [None, '[{"id":"5","name":"o\'neil","email":"A@B","signup_date":"2024-01-05"}] trailing', '[{"id":6,"name":"élan mc-d"},{"id":null},{"id":"x"},{"name":"n"}]']
    df = _texts(spark, forms)
    native, python = (sorted(map(repr, f(df).collect())) for f in (customers.stg_customers_tolerant, customers.stg_customers_tolerant_pandas))
    assert native == python and len(native) >= 3


def test_trailing_text_reaches_no_model(spark):
    day = '{"location":{"name":"A","lat":1,"lon":2},"forecast":{"forecastday":[{"date":"2024-01-01","hour":[{"time_epoch":1704067200,"temp_c":1}]}]}}'
    raw = spark.createDataFrame([(day, "u/history.json?a", 0), (day + " x", "u/history.json?b", 1)], "raw_json string, source_url string, n int")
    got = weather.flatten_weather(raw.withColumn("fetched_at", F.timestamp_seconds("n"))).collect()
    assert [r.source_url for r in got] == ["u/history.json?a"]
    user = '{"user_id":1,"sessions":[{"session_id":"s","events":[{"event_type":"e","ts":"2024-01-01T00:00:00Z"}]}]}'
    assert nested.stg_sessions_events(_texts(spark, [user, f"[{user}]", user + "!"]).withColumnRenamed("raw_json", "raw")).count() == 2


def test_quarantine_names_document_and_reason(spark):
    df = _texts(spark, GOOD + BAD)
    got = quarantine(df, keep=["raw_json"]).collect()
    assert sorted(r.raw_json for r in got) == sorted(BAD)
    assert {(r.item, r.reason) for r in got} == {(None, "the text is not one JSON document")}
    assert all(r.bytes == len(r.raw_json.encode()) for r in got)


def test_array_of_200_mb_and_an_item_beyond_a_variant():
    """In a session of its own: this session's heap is too small."""
    run = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "large_documents_job.py")], capture_output=True, text=True, timeout=600,
                         env=os.environ | {"PYTHONPATH": ROOT})
    assert run.returncode == 0, run.stderr[-2000:]
    got = json.loads(run.stdout.strip().splitlines()[-1])
    assert got["bytes"] > 200_000_000
    assert got["strict"] == got["tolerant"] == [2_000_000, 2_000_000 * 2_000_001 // 2]
    assert got["kept"] == [1, 3]
    assert [(item, reason) for item, _, reason in got["rejected"]] == [(2, "the item exceeds a VARIANT")]
    assert got["rejected"][0][1] > 150_000_000
