"""Appends on narrow keys, the bucketed raw table, routed loads."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans import raw_load
from tidewater.session import ensure_local_dir, scratch_path
from tidewater.sinks import tables


def _batch(spark, ids, payload="p"):
    df = spark.createDataFrame([(f"{payload}{i}", f"u{i}") for i in ids], "raw_json string, source_url string")
    at = F.lit("2024-02-01 06:00:00").cast("timestamp") + F.make_interval(days=(F.length("source_url") % 2).cast("int"))
    return tables.with_row_id(df.withColumn("fetched_at", at))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _nodes(plan, *kinds):
    return [line for line in plan.splitlines() if any(line.lstrip(" :+-*()0123456789").startswith(k) for k in kinds)]


def _ancestors(plan, mark):
    """Nodes above the first line that holds ``mark``, from the nearest up."""
    lines = plan.splitlines()
    depth = lambda line: max(line.find("+- "), line.find(":- "))
    at = next(i for i, line in enumerate(lines) if mark in line)
    out, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            out.append(line)
            level = depth(line)
    return out


def _table(spark, buckets=4):
    path = scratch_path(spark, "t_bucketed")
    name = "t_" + path.rsplit("-", 1)[-1]
    tables.ensure_raw_table(spark, name, path, buckets=buckets)
    return name


def test_bucketed_target_is_read_without_an_exchange(spark):
    name = _table(spark)
    assert tables.append_bucketed(spark, _batch(spark, range(50)), name) == {"inserted": 50}
    plan = _plan(tables.bucketed_exceptions(spark, _batch(spark, range(30, 80)), name))
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    above = _ancestors(plan, "Bucketed: true")
    join = next(i for i, node in enumerate(above) if "Join" in node)
    assert not [node for node in above[:join] if "Exchange" in node]
    assert not [line for line in _nodes(plan, "Exchange", "Sort") if "raw_json" in line]
    assert "raw_json" not in next(line for line in plan.splitlines() if "Bucketed: true" in line).split("ReadSchema")[1]


def test_payload_is_neither_sorted_nor_shuffled(spark):
    path = scratch_path(spark, "t_append")
    assert tables.append_idempotent(spark, _batch(spark, range(40)), path) == {"inserted": 40}
    batch = _batch(spark, range(40, 90))
    plan = _plan(tables.new_rows(spark, batch, path))
    assert not _nodes(plan, "Exchange", "Sort", "SortAggregate", "BroadcastExchange")
    overlap = _plan(tables.new_rows(spark, _batch(spark, range(80)), path))
    assert not [n for n in _nodes(overlap, "Exchange", "Sort") if "raw_json" in n]
    keys = _plan(tables.key_exceptions(batch, spark.read.parquet(path), "row_id", "fetched_date"))
    assert not [n for n in _nodes(keys, "Exchange", "Sort") if "raw_json" in n]


@pytest.mark.parametrize("broadcast", [0, 1000])
@pytest.mark.parametrize("gather", [False, True])
def test_bucketed_appends_are_idempotent(spark, monkeypatch, broadcast, gather):
    monkeypatch.setattr(tables, "BROADCAST_KEYS", broadcast)
    name = _table(spark)
    first = _batch(spark, range(20))
    assert tables.append_bucketed(spark, first.unionByName(first), name, gather) == {"inserted": 20}
    assert tables.append_bucketed(spark, _batch(spark, range(10, 35)), name, gather) == {"inserted": 15}
    assert tables.append_bucketed(spark, _batch(spark, range(35)), name, gather) == {"inserted": 0}
    stored = spark.table(name)
    assert sorted(r.source_url for r in stored.collect()) == sorted(f"u{i}" for i in range(35))
    with pytest.raises(Exception, match="different rows share the key"):
        tables.append_bucketed(spark, _batch(spark, [99]).unionByName(_batch(spark, [99], "q")), name)
    with pytest.raises(Exception, match="NULL in required column"):
        tables.append_bucketed(spark, _batch(spark, [100]).withColumn("raw_json", F.lit(None).cast("string")), name)
    assert spark.table(name).count() == 35


def test_existing_folder_is_registered_again(spark):
    path = scratch_path(spark, "t_again")
    name = "t_" + path.rsplit("-", 1)[-1]
    tables.ensure_raw_table(spark, name, path, buckets=4)
    tables.append_bucketed(spark, _batch(spark, range(9)), name)
    tables.ensure_raw_table(spark, name + "_x", path, buckets=4)
    assert tables.append_bucketed(spark, _batch(spark, range(12)), name + "_x") == {"inserted": 3}


def _files(spark, **texts):
    root = ensure_local_dir(scratch_path(spark, "t_landing"))
    for name, text in texts.items():
        with open(os.path.join(root, name + ".json"), "w", encoding="utf-8") as f:
            f.write(text)
    return root


def test_routed_load(spark):
    landing = _files(spark, customers='[{"id": 1}]', Orders='{"a": "å"}', bad='{"a": ', trail="[1] x")
    root = scratch_path(spark, "t_routed")
    db = "tw_" + root.rsplit("-", 1)[-1]
    got = raw_load.load_routed(spark, landing + "/*.json", root, db, "2024-02-01 06:00:00", location="59.3,18.1")
    assert got == {"status": "success", "location": "59.3,18.1", "date": "2024-02-01", "database": db, "inserted": 2, "skipped": 2}
    assert sorted(t.name for t in spark.catalog.listTables(db)) == ["quarantine", "raw_customers", "raw_orders"]
    one = spark.table(f"{db}.raw_orders")
    assert [(r.raw_json, r.source.rsplit("/", 1)[1]) for r in one.collect()] == [('{"a": "å"}', "Orders.json")]
    assert spark.table(f"{db}.quarantine").count() == 2
    retry = raw_load.load_routed(spark, landing + "/*.json", root, db, "2024-02-01 06:00:00")
    assert (retry["status"], retry["inserted"], retry["skipped"]) == ("success", 0, 0)
    later = raw_load.load_routed(spark, landing + "/c*.json", root, db, "2024-02-02 06:00:00")
    assert later["inserted"] == 1 and spark.table(f"{db}.raw_customers").count() == 2


def test_routed_load_reports_no_files_and_errors(spark, monkeypatch):
    root = scratch_path(spark, "t_none")
    got = raw_load.load_routed(spark, "/tmp/no-such-folder-tw/*.json", root, "tw_none", "2024-02-01 06:00:00")
    assert (got["status"], got["inserted"], got["date"]) == ("no_files", 0, "2024-02-01")
    assert not tables._exists(spark, root)
    landing = _files(spark, a="[1]")
    real = raw_load.scan_json_files
    monkeypatch.setattr(raw_load, "scan_json_files", lambda *a: real(*a).withColumn("raw_json", F.lit(None).cast("string")))
    got = raw_load.load_routed(spark, landing + "/*.json", root, "tw_err", "2024-02-01 06:00:00")
    assert got["status"] == "error" and got["inserted"] == 0 and "NULL in required column" in got["error"]


def test_unrouted_load_counts_in_the_write(spark):
    landing = _files(spark, a="[1]", b="{oops", c="{}")
    target = scratch_path(spark, "t_unrouted")
    load = lambda: raw_load.load_raw_files(spark, landing + "/*.json", target, "2024-02-01 06:00:00")
    assert load() == {"status": "success", "inserted": 2, "skipped": 1}
    assert load()["inserted"] == 0 and spark.read.parquet(target).count() == 2
    assert raw_load.load_raw_files(spark, landing + "/*.json", target)["inserted"] == 2   # a run of its own time
