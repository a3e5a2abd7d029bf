"""Semantics of the column functions."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater import functions as fn


def _one(spark, col, text):
    return spark.createDataFrame([(text,)], "t string").select(col.alias("x")).first().x


DOC = '{"a":{"b":1},"arr":[1,{"x":2},"s"],"n":null,"s":"hi","num":1.50,"e":"é"}'


@pytest.mark.parametrize("path,expected", [
    ("$.s", "hi"), ("$.a", None), ("$.arr", None), ("$.n", None), ("$.missing", None),
    ("$.a.b", "1"), ("$.arr[1].x", "2"), ("$.e", "é")])
def test_json_value(spark, path, expected):
    assert _one(spark, fn.json_value(fn.safe_parse("t"), path), DOC) == expected


def test_json_value_bad_text_is_null(spark):
    assert _one(spark, fn.json_value(fn.safe_parse("t"), "$.s"), "{bad") is None


def test_json_query_keeps_quotes_and_objects(spark):
    assert _one(spark, fn.json_query(fn.safe_parse("t"), "$.s"), DOC) == '"hi"'
    assert _one(spark, fn.json_query(fn.safe_parse("t"), "$.a"), DOC) == '{"b":1}'


def test_json_query_array(spark):
    assert _one(spark, F.size(fn.json_query_array(fn.safe_parse("t"), "$.arr")), DOC) == 3
    assert _one(spark, fn.json_query_array(fn.safe_parse("t"), "$.a"), DOC) is None


def test_strict_parse_fails(spark):
    with pytest.raises(Exception):
        _one(spark, fn.strict_parse("t"), "{bad")


def test_safe_cast(spark):
    assert _one(spark, fn.safe_cast("t", "bigint"), "12.0") is None
    assert _one(spark, fn.safe_cast("t", "bigint"), "12") == 12
    assert str(_one(spark, fn.safe_cast("t", fn.NUMERIC), "1.5")) == "1.500000000"


def test_to_numeric_and_date_coerce(spark):
    assert _one(spark, fn.to_numeric_coerce("t"), " 7 ") == 7
    assert _one(spark, fn.to_numeric_coerce("t"), "x7") is None
    assert _one(spark, fn.to_date_coerce("t"), "2024-13-45") is None
    assert str(_one(spark, fn.to_date_coerce("t"), "2024-02-03")) == "2024-02-03"


def test_initcap_vs_title(spark):
    s = "o'neil MARY-jane mc_donald élan a1b x.y"
    assert _one(spark, fn.title_python("t"), s) == s.title()
    assert _one(spark, fn.initcap_sql("t"), s) == "O'neil Mary-Jane Mc_Donald Élan A1b X.Y"


ALPHABET = string.ascii_letters + string.digits + " -_.'#/(),:;!?" + "éÉßøæǆǄǉ"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=8))
def test_title_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(fn.title_python("t").alias("x")).collect()]
    assert got == [t.title() for t in texts]


def test_fallback_and_stamps(spark):
    df = spark.createDataFrame([("", None)], "a string, b string")
    a, b = F.col("a"), F.col("b")         # plain strings are literal candidates
    assert df.select(fn.fallback(a, b, "d").alias("x")).first().x == "d"
    assert df.select(fn.fallback(a, "d", empty_is_missing=False).alias("x")).first().x == ""
    ts = F.lit("2024-03-01 00:30:00").cast("timestamp")
    r = df.select(fn.utc_stamp(ts).alias("i"), fn.compact_stamp(ts).alias("c"),
                  fn.yesterday(ts).alias("y")).first()
    assert (r.i, r.c, r.y) == ("2024-03-01T00:30:00+00:00", "20240301T003000Z", "2024-02-29")


def test_keys(spark):
    df = spark.createDataFrame([(59.3, 18.1, 1700000000)], "lat double, lon double, e bigint")
    r = df.select(fn.location_key("lat", "lon", "e").alias("k"),
                  fn.md5_hex(fn.location_key("lat", "lon", "e")).alias("h")).first()
    import hashlib
    assert r.k == "59.3,18.1|1700000000"
    assert r.h == hashlib.md5(r.k.encode()).hexdigest()


def test_text_kind_matches_value_kind(spark):
    from tidewater.functions.json import json_kind, text_kind
    docs = [' \n\t[{"a":1}]', '{"a":[1]}', '  "x"', "12", "null", "[]", "{}"]
    df = spark.createDataFrame([(d,) for d in docs], "t string")
    rows = df.select(text_kind("t").alias("k"), json_kind(fn.safe_parse("t")).alias("j")).collect()
    for r in rows:
        assert r.k == (r.j if r.j in ("OBJECT", "ARRAY") else "SCALAR")


def test_ingest_plan_body_then_args(spark):
    from tidewater.sources.requests import ingest_plan
    df = spark.createDataFrame([("b", "a", None, "2024-01-02"), ("", "a", "", None), (None, None, None, None)],
                               "body_loc string, arg_loc string, body_date string, arg_date string")
    out = ingest_plan(df, default_location="d", as_of="2024-03-10 12:00:00",
                      location_col=["body_loc", "arg_loc"], date_col=["body_date", "arg_date"]).collect()
    assert [(r.resolved_location, r.resolved_date) for r in out] == [
        ("b", "2024-01-02"), ("a", "2024-03-09"), ("d", "2024-03-09")]
    assert out[0].source_url.endswith("?q=b&dt=2024-01-02")


def _initcap_rule(s: str) -> str:
    from tidewater.functions.text import INITCAP_DELIMITERS
    out, prev = [], None
    for ch in s.lower():
        boundary = prev is None or prev.isspace() or prev in INITCAP_DELIMITERS
        out.append(ch.upper() if boundary else ch)
        prev = ch
    return "".join(out)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET + "\t\n[]{}|\\<>!?@\"^$&~,:;*%+", max_size=24),
                min_size=1, max_size=8))
def test_initcap_matches_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(fn.initcap_sql("t").alias("x")).collect()]
    assert got == [_initcap_rule(t) for t in texts]


def test_title_matches_python_on_every_letter_and_sigma(spark):
    # letters whose case mapping is newer than Python's tables (Unicode 16)
    newer = {0x19B, 0x264, 0x1C89, 0x1C8A, 0xA7CB, 0xA7CC, 0xA7CD, 0xA7DA, 0xA7DB, 0xA7DC}
    letters = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF and i not in newer]
    texts = [t for c in letters for t in (c, "a" + c + "b", c + "a")] + ["ΟΔΟΣ ΣΑΣ'Α Σ", "ΑΣ'Α", "ΑΣ-", "İİ iİx", "i\u0307x", "😀a𐐀𐐀", "", " ", "é"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.title_python("t").alias("x")).collect()
    assert [(r.t, r.x, r.t.title()) for r in got if r.x != r.t.title()] == []


DATES = ["2024-01-05", "2024-1-5", "2024-01-05T10:00:00Z", "2024-01-05T10:00:00.123", "2024-01-05 10:00:00+02:00", "2024-01-05T23:30:00-0500", "2024/01/05", "20240105",
         "Jan 5, 2024", "January 5 2024", "5 Jan 2024", "05-Jan-2024", "5 march 2024", "01/05/2024", "13/05/2024", "1-5-2024", "2024-01", "2024/03", "2024", "2024-Jan-05",
         "Fri, 05 Jan 2024 10:00:00 GMT", "Jan 5, 2024 10:30 PM", "Sept 3, 2024", " 2024-02-29 ", "2024-01-05 10:30", "2024-01-05 10:30 UTC", "1.5.2024"]
NO_DATES = ["2023-02-29", "2024-13-45", "2024-01-05 25:00", "2024-01-05T10:61:00", "not a date", "", "Foo 5, 2024", "2024-01-05x", "32/01/2024", "2024-01-05 10:00:00+2500", "05/2024/01"]


def test_dates_match_pandas_value_by_value(spark):
    import pandas as pd
    df = spark.createDataFrame([(t,) for t in DATES + NO_DATES], "t string").select("t", fn.to_date_coerce("t").alias("d"))
    got = {r.t: r.d for r in df.collect()}
    want = {t: pd.to_datetime(t, errors="coerce") for t in DATES}
    assert {t: got[t] for t in DATES} == {t: w.date() for t, w in want.items()}
    assert all(got[t] is None for t in NO_DATES)


JSON_TEXTS = ['{\n "k" : "\\u00e5",\t"a":1}', '[ ]', '{}', ' [1,[2 , {"b":{}}],"x, y: z"] ', '"\\ud83d\\ude00\\/\\u001f\\u000a\\u0022\\u005c"', '"\\\\u0041 \\\\"', "null", "-1.5",
              '{"å":"\u2028\x7f","a\\tb":[true,false,null]}', '"' + "x\\n" * 100_000 + '"', "[" * 300 + "]" * 300]


def test_json_rewritten_matches_python(spark):
    import json
    df = spark.createDataFrame([(t,) for t in JSON_TEXTS], "t string").select("t", fn.json_rewritten("t").alias("x"))
    assert [(r.t, r.x) for r in df.collect() if r.x != json.dumps(json.loads(r.t), ensure_ascii=False)] == []
    # numbers, repeated keys and halves of a pair stay as written
    for kept in ['{"a": 1.50, "a": 1E5}', '"\\ud83d x"']:
        assert _one(spark, fn.json_rewritten("t"), kept) == kept
    for bad in ["[1] x", '{"a":', "", None]:
        assert _one(spark, fn.json_rewritten("t"), bad) is None


def test_scan_rewrites_escaped_pretty_printed_files(spark, tmp_path):
    from tidewater.sources.files import scan_json_files
    (tmp_path / "a.json").write_text('{\n  "k": "\\u00e5",\n  "a": 1\n}\n', encoding="utf-8")
    (tmp_path / "b.json").write_text("[1] x", encoding="utf-8")
    got = sorted(r.raw_json for r in scan_json_files(spark, f"{tmp_path}/*.json", normalise=True).collect())
    assert got == ["[1] x", '{"k": "å", "a": 1}']
