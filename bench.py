"""Benchmark: headline flatten/mart queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Fixture packing (flat driver tables -> nested JSON documents) runs once and
is written to the shared folder; it is reported apart (``pack_*``).  Each
query is then timed end to end from the packed inputs with a ``noop`` sink
(full execution, nothing collected): warm session, median of $BENCH_REPS (default 5).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater import fixtures as fx  # noqa: E402
from tidewater.plans import customers as cu  # noqa: E402
from tidewater.plans import nested, weather  # noqa: E402
from tidewater.session import build_session, input_bytes, scratch_path, size_for_input  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "5"))


def run(df) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def timed_write(df, path, files: int) -> float:
    """Land a packed input as ``files`` files (a landing folder holds many
    files; one big row group would leave cores idle while parsing)."""
    t = time.perf_counter()
    df.repartition(files).write.mode("overwrite").parquet(path)
    return time.perf_counter() - t


def main():
    spark = build_session(f"local[{CPUS}]", app_name="tidewater-bench", shuffle_partitions=CPUS * 2,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    t = lambda n: fx.read_table(spark, SF_DIR, n)
    root = scratch_path(spark, "bench")

    packed = {
        "weather_raw": fx.weather_envelopes(t("events")),
        "orders_nested": fx.orders_nested(t("orders"), t("lineitem")),
        "playlists_nested": fx.playlists_nested(t("supplier"), t("lineitem"), t("part")),
        "sessions_json": fx.sessions_documents(t("events")),
        "customer_docs": fx.customer_documents(t("customer")),
        "customer_docs_dirty": fx.customer_documents_dirty(t("customer")),
    }
    pack_times = {f"pack_{k}": round(timed_write(df, f"{root}/{k}", CPUS * 4), 3)
                  for k, df in packed.items()}
    p = lambda n: spark.read.parquet(f"{root}/{n}")
    shuffle_partitions = size_for_input(spark, input_bytes(spark, *[f"{root}/{k}" for k in packed]))

    queries = {
        "weather_hourly": lambda: weather.stg_weather_hourly(p("weather_raw")),
        "weather_daily": lambda: weather.fct_weather_daily(weather.stg_weather_hourly(p("weather_raw"))),
        "orders_items": lambda: nested.stg_orders_items(p("orders_nested")),
        "playlist_tracks": lambda: nested.fct_tracks(p("playlists_nested")),
        "sessions_events": lambda: nested.fct_sessions_events(p("sessions_json")),
        "customers_strict": lambda: cu.stg_customers(p("customer_docs")),
        "customers_tolerant": lambda: cu.stg_customers_tolerant(p("customer_docs_dirty")),
        "daily_signups": lambda: cu.int_customer_signups(cu.stg_customers(p("customer_docs"))),
    }
    # warm-up: JIT, file listing, codegen caches
    for q in queries.values():
        run(q())
    times = {}
    for name, q in queries.items():
        samples = [run(q()) for _ in range(REPS)]
        times[name] = round(statistics.median(samples), 3)
    total = round(sum(times.values()), 3)

    # streaming (reported apart, one run): three out-of-order deliveries
    # through the keyed state, then the daily windows over the newest hours
    from tidewater import streaming as st
    landing = f"{root}/landing"
    n_files = fx.land_weather_deliveries(spark, t("events"), landing, files_per_delivery=CPUS)
    store = st.NewestHours(spark, f"{root}/store")
    t0 = time.perf_counter()
    store.start_hours(st.read_envelopes(spark, landing, max_files_per_trigger=n_files), f"{root}/ckpt_hours").awaitTermination()
    t1 = time.perf_counter()
    store.start_days(f"{root}/ckpt_days").awaitTermination()
    streaming = {"stream_newest_wins_3_batches": round(t1 - t0, 3), "stream_daily": round(time.perf_counter() - t1, 3)}
    sf = os.path.basename(SF_DIR).replace("sf", "")
    print(json.dumps({"metric": "flatten_and_mart_total_median_sec", "value": total, "unit": "sec",
                      "queries": times, "pack": pack_times, "streaming": streaming, "sf": float(sf) if sf else sf,
                      "cpus": CPUS, "reps": REPS, "shuffle_partitions": shuffle_partitions}))
    spark.stop()


if __name__ == "__main__":
    main()
