"""The command line runs a model over stored inputs."""

import json
import os

from tidewater import fixtures as fx
from tidewater.__main__ import main
from tidewater.plans import weather
from tidewater.session import scratch_path


def test_cli_weather_daily(spark, sf_dir):
    raw_path, out = scratch_path(spark, "cli_raw"), scratch_path(spark, "cli_out")
    fx.weather_envelopes(fx.read_table(spark, sf_dir, "events")).write.parquet(raw_path)
    assert main(["run", "weather_daily", "--input", f"raw={raw_path}", "--output", out]) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(out).select(
        "weather_day_key", "city", "country", "lat", "lon", "day_utc", "hours_count",
        "avg_temp_c", "min_temp_c", "max_temp_c").collect())
    expected = sorted(tuple(r) for r in weather.fct_weather_daily(
        weather.stg_weather_hourly(spark.read.parquet(raw_path))).collect())
    assert got == expected and len(got) > 0


def test_cli_loads_files_with_and_without_tables(spark, capsys):
    root = scratch_path(spark, "cli_landing")
    os.makedirs(root)
    for name, text in (("a.json", "[1]"), ("bad.json", "{")):
        with open(f"{root}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    out = scratch_path(spark, "cli_files")
    assert main(["load-files", "--glob", f"{root}/*.json", "--output", out]) == 0
    db = "tw_" + out.rsplit("-", 1)[-1]
    assert main(["load-files", "--glob", f"{root}/*.json", "--output", out + "_r", "--database", db]) == 0
    plain, routed = (json.loads(line) for line in capsys.readouterr().out.strip().splitlines()[-2:])
    assert plain == {"status": "success", "inserted": 1, "skipped": 1}
    assert (routed["status"], routed["inserted"], routed["skipped"], routed["database"]) == ("success", 1, 1, db)
    assert spark.table(f"{db}.raw_a").count() == 1
