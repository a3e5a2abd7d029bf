"""Command line: run one model over stored inputs and write its output.

    python -m tidewater run weather_daily --input raw=/data/raw/weather \\
        --output /data/marts/fct_weather_daily
    python -m tidewater load-files --glob '/landing/*.json' --output /data/raw/files
    python -m tidewater list

Inputs are parquet paths (``name=path``); outputs are written as parquet
(day-partitioned for the daily mart).  Each model is one plan function;
models that read another model's output call it directly.
"""

from __future__ import annotations

import argparse
import json

from .plans import customers as cu
from .plans import nested, weather
from .plans.raw_load import load_raw_files, load_routed
from .session import build_session, input_bytes, size_for_input
from .sinks.tables import as_partitioned_table

# model -> (required input names, plan)
MODELS = {
    "weather_hourly": (["raw"], lambda i: weather.stg_weather_hourly(i["raw"])),
    "weather_daily": (["raw"], lambda i: weather.fct_weather_daily(weather.stg_weather_hourly(i["raw"]))),
    "orders_items": (["orders"], lambda i: nested.stg_orders_items(i["orders"])),
    "playlist_tracks": (["playlists"], lambda i: nested.fct_tracks(i["playlists"])),
    "sessions_events": (["sessions_json"], lambda i: nested.fct_sessions_events(i["sessions_json"])),
    "customers_strict": (["raw"], lambda i: cu.stg_customers(i["raw"])),
    "customers_tolerant": (["raw"], lambda i: cu.stg_customers_tolerant(i["raw"])),
    "customers_semi_raw": (["semi_raw"], lambda i: cu.stg_customers_semi_raw(i["semi_raw"])),
    "customers_deduped": (["semi_raw"], lambda i: cu.stg_customers_deduped(i["semi_raw"])),
    "transformed_customers": (["raw"], lambda i: cu.transformed_customers(i["raw"])),
    "daily_signups": (["raw"], lambda i: cu.int_customer_signups(cu.stg_customers(i["raw"]))),
}
PARTITIONED = {"weather_daily": ("day_utc", ("city",))}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tidewater")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("model", choices=sorted(MODELS))
    run.add_argument("--input", action="append", default=[], help="name=parquet path")
    run.add_argument("--output", required=True)
    load = sub.add_parser("load-files")
    load.add_argument("--glob", required=True)
    load.add_argument("--output", required=True)
    load.add_argument("--database", help="route files to tables of this database")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name, (needs, _) in sorted(MODELS.items()):
            print(f"{name}: inputs {', '.join(needs)}")
        return 0
    spark = build_session(app_name=f"tidewater-{args.cmd}")
    if args.cmd == "load-files":
        landed = [f for f in (args.glob.rsplit("/", 1)[0],) if "*" not in f]
        size_for_input(spark, input_bytes(spark, *landed), expansion=1.0)
        if args.database:
            print(json.dumps(load_routed(spark, args.glob, args.output, args.database)))
        else:
            print(json.dumps(load_raw_files(spark, args.glob, args.output)))
        return 0
    needs, plan = MODELS[args.model]
    paths = dict(x.split("=", 1) for x in args.input)
    missing = [n for n in needs if n not in paths]
    if missing:
        ap.error(f"{args.model} needs --input {' '.join(m + '=PATH' for m in missing)}")
    size_for_input(spark, input_bytes(spark, *[paths[n] for n in needs]))
    out = plan({n: spark.read.parquet(paths[n]) for n in needs})
    if args.model in PARTITIONED:
        part, cluster = PARTITIONED[args.model]
        as_partitioned_table(spark, out, args.output, part, cluster)
    else:
        out.write.mode("overwrite").parquet(args.output)
    print(json.dumps({"model": args.model, "output": args.output}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
