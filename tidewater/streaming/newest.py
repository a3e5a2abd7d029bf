"""STR-3 and STR-4: newest hour per location and time, and the daily mart, as
stateful streams.

*Hours* (``start_hours``): a keyed state keeps the newest row of every (lat,
lon, time_epoch) under the total order of the batch model; update mode hands
on the hours whose row a micro-batch replaced, which are appended to a log
below ``hours``.  Hours of one day are kept by buckets, each a compressed Arrow
table: an hour takes some tens of bytes of state, and the update function is
called once per touched bucket.

*Days* (``start_days``): the hours log is itself a stream.  Its rows fall into
event-time windows of one day; a window's state holds the newest row of each
of its hours, and a touched window's mart rows are appended to a log below
``days``.  Windows of one day are kept in state by buckets of locations, so
the update function is called once per bucket and not once per window.

Both logs only ever gain rows, and what a reader makes of them (the greatest
row per hour, the last emission per window) does not depend on the order in
which rows came or on how often.  So a replayed micro-batch, a restart, a lost
checkpoint (the landed files are read again from the start) or a half-written
append cost duplicates and nothing else.  ``compact`` rewrites a log's files
as one row per key and then removes them; stopped at any point, it leaves
duplicates at worst.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import NUMERIC, epoch_to_timestamp
from ..plans.weather import HOURLY_COLUMNS, HOURLY_ORDER, dedup_hours, fct_weather_daily, flatten_weather, weather_hour_id
from ..session import input_bytes
from ..sinks.tables import _exists, write_partitioned

# Columns of the order that are ranked from high to low, as values that rise
# then, and back.
_REVERSED = {"fetched_at": (lambda c: F.bitwise_not(F.unix_micros(c)), lambda c: F.timestamp_micros(F.bitwise_not(c))),
             "temp_c": (F.negative, F.negative), "humidity": (F.bitwise_not, F.bitwise_not)}


def _ranks(order=HOURLY_ORDER) -> list[tuple[str, bool]]:
    """(column, descending) of an order."""
    return [(name, direction == ["desc"]) for name, *direction in (spec.split() for spec in order)]


def order_text(order=HOURLY_ORDER) -> Column:
    """The place of an hourly row in the total order of the batch model, a
    struct; the row with the smallest stays.  NULL ranks last in both
    directions."""
    fields = []
    for name, descending in _ranks(order):
        c = F.col(name)
        fields += [c.isNull().alias(f"no_{name}"), (_REVERSED[name][0](c) if descending else c).alias(name)]
    return F.struct(*fields)


def newest_hours(flat: DataFrame) -> DataFrame:
    """The newest row per (lat, lon, time_epoch) of a table, as a keyed
    aggregate of rows that begin with their own place in the order.  (It runs on
    a stream too, with a state row of over 500 bytes per key.)"""
    reversed_ = {name for name, descending in _ranks() if descending}
    ranked = {name for name, _ in _ranks()}
    whole = flat.select(order_text().alias("place"), F.struct(*(c for c in HOURLY_COLUMNS if c not in ranked)).alias("rest"))
    best = whole.groupBy(F.col("rest.lat").cast("string").alias("lat_key"), F.col("rest.lon").cast("string").alias("lon_key"),
                         F.col("rest.time_epoch").alias("hour_key")).agg(F.min(F.struct("place", "rest")).alias("row"))
    value = lambda c: F.col(f"row.place.{c}" if c in ranked else f"row.rest.{c}")
    return best.select(*((_REVERSED[c][1](value(c)) if c in reversed_ else value(c)).cast(flat.schema[c].dataType).alias(c) for c in HOURLY_COLUMNS))


# Columns that pass through Python as text (pandas has no whole numbers with
# NULLs): to a whole number or number, back, and the Arrow type they are ranked as.
_AS_TEXT = {"lat": (lambda c: c, lambda c: c.cast("double"), "string"), "lon": (lambda c: c, lambda c: c.cast("double"), "string"),
            "time_epoch": (lambda c: c, lambda c: c.cast("bigint"), "int64"),
            "fetched_at": (F.unix_micros, lambda c: F.timestamp_micros(c.cast("bigint")), "int64"),
            "temp_c": (lambda c: c, lambda c: c.cast(NUMERIC), "decimal"), "humidity": (lambda c: c, lambda c: c.cast("bigint"), "int64"),
            "day_date": (F.unix_date, lambda c: F.date_from_unix_date(c.cast("int")), "int32")}

# What tells hours apart, by its text as in the batch model, and the columns
# of a row in state; the others are worked out from them.
_HOUR_KEY = ("lat", "lon", "time_epoch")
_STATE_COLUMNS = [*_HOUR_KEY, *(name for name, _ in _ranks())]

# Buckets that the hours of one day are dealt over by their key, where a stream
# is started without a number; and the landed bytes that make one, were they all
# of one day.
HOUR_BUCKETS = 32
LEAST_HOUR_BUCKETS = 8
BUCKET_BYTES = 64 << 20


def hour_buckets(spark: SparkSession, landing: str) -> int:
    """Buckets for the hours of the feed landed so far at ``landing``."""
    return max(LEAST_HOUR_BUCKETS, -(-input_bytes(spark, landing) // BUCKET_BYTES))


def newest_hours_kept(flat: DataFrame, buckets: int = HOUR_BUCKETS) -> DataFrame:
    """On a stream of flat hours: the rows that became the newest of their
    (lat, lon, time_epoch) in a micro-batch.  State: of every day and bucket
    of keys one Arrow table, compressed, of the newest rows.  Every key is in
    one bucket, so a location or a day with very many hours is spread over
    buckets and tasks."""
    ranks, columns = _ranks(), list(_STATE_COLUMNS)
    kinds = {name: _AS_TEXT[name][2] for name, _ in ranks if name in _AS_TEXT}

    def update(key, frames, state):
        import pyarrow as pa
        import pyarrow.compute as pc
        schema = pa.schema([(c, pa.string()) for c in columns])
        kept = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else schema.empty_table()
        came = [pa.Table.from_pandas(frame, schema, preserve_index=False) for frame in frames]
        rows = pa.concat_tables([kept, *came]).combine_chunks()
        types = {"int32": pa.int32(), "int64": pa.int64(), "decimal": pa.decimal128(38, 9)}
        # NULL ranks last in both directions; of equal rows the kept one stays.
        hour = pc.binary_join_element_wise(*(rows[c] for c in columns[:3]), "|", null_handling="replace", null_replacement="~")
        order = pa.table({"hour": hour, **{c: rows[c].cast(types[kinds[c]]) if c in kinds else rows[c] for c, _ in ranks},
                          "at": pa.array(range(len(rows)), pa.int64())})
        by = [("hour", "ascending"), *((c, "descending" if down else "ascending") for c, down in ranks), ("at", "ascending")]
        ranked = pc.sort_indices(order, sort_keys=by, null_placement="at_end")
        hours = hour.take(ranked)
        first = pa.concat_arrays([pa.array([True]), *pc.not_equal(hours[1:], hours[:-1]).chunks])
        best = ranked.filter(first)
        new = best.filter(pc.greater_equal(best, len(kept)))
        if len(new):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows.take(best).combine_chunks())
            state.update((sink.getvalue().to_pybytes(),))
            for some in rows.take(new).to_batches(max_chunksize=10_000):
                yield some.to_pandas()

    text = lambda c: (_AS_TEXT[c][0](F.col(c)) if c in _AS_TEXT else F.col(c)).cast("string").alias(c)
    rows = flat.select(F.unix_date(F.to_date("observed_at")).alias("day"), *(text(c) for c in columns))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*_HOUR_KEY), F.lit(buckets)))
    found = rows.groupBy("day", "bucket").applyInPandasWithState(
        update, ", ".join(f"{c} string" for c in columns), "hours binary", "update", GroupStateTimeout.NoTimeout)
    found = found.select(*(_AS_TEXT[c][1](F.col(c)).alias(c) if c in _AS_TEXT else c for c in columns))
    return found.withColumns({"observed_at": epoch_to_timestamp(F.col("time_epoch")), "weather_hour_id": weather_hour_id()}).select(*HOURLY_COLUMNS)


def _append_once(rows: DataFrame, path: str, cluster: tuple) -> None:
    """Append a micro-batch's rows; they are kept meanwhile, since the range
    partitioning looks at them first (lost blocks are worked out again)."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_partitioned(rows, path, "day_utc", cluster, mode="append", dynamic=False)
    finally:
        rows.unpersist()


# How far a window had come when its mart rows were emitted; the last value
# orders emissions of equal progress.
PROGRESS = ("hours", "fetched", "emitted_at")


# Windows of one day that share a state row, about, when a days stream first
# starts; the fewest buckets a day's locations are dealt over.
BUCKET_WINDOWS = 256
LEAST_BUCKETS = 8


class NewestHours:
    """The hours and days streams of one weather feed, stored below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.hours_log = f"{root}/hours"
        self.days_log = f"{root}/days"
        none = spark.createDataFrame([], "raw_json string, source_url string, fetched_at timestamp")
        self._hours = newest_hours(flatten_weather(none)).withColumn("day_utc", F.to_date("observed_at"))
        self._days = fct_weather_daily(self._with_progress(self._hours).withColumn("emitted_at", F.current_timestamp()), PROGRESS)

    @staticmethod
    def _with_progress(hours: DataFrame) -> DataFrame:
        """How far each window has come: its hours and the sum of their fetch times."""
        window = Window.partitionBy("lat", "lon", F.to_date("observed_at"))
        return hours.withColumns({"hours": F.count(F.lit(1)).over(window),
                                  "fetched": F.sum(F.unix_micros("fetched_at").cast("decimal(38,0)")).over(window).cast("decimal(38,0)")})

    # ------------------------------------------------------------ streams

    def append_hours(self, batch: DataFrame, _: int = 0) -> None:
        out = batch.select(*HOURLY_COLUMNS).withColumn("day_utc", F.to_date("observed_at"))
        _append_once(out, self.hours_log, ("lat", "lon"))

    def start_hours(self, envelopes: DataFrame, checkpoint: str, available_now: bool = True, buckets: int = HOUR_BUCKETS):
        """STR-3 on a stream of envelopes; ``buckets`` (``hour_buckets``) holds
        for a checkpoint from its first start on."""
        chosen = self._buckets(checkpoint, lambda: self.spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")))
        newest = newest_hours_kept(flatten_weather(envelopes.select("raw_json", "source_url", "fetched_at")), chosen)
        w = newest.writeStream.outputMode("update").foreachBatch(self.append_hours).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()

    def windows(self, hours: DataFrame, lateness: str | None = None, buckets: int = LEAST_BUCKETS) -> DataFrame:
        """All newest hours of every one-day window that ``hours`` touches.
        The windows of one day whose locations share one of the ``buckets``
        share a state row and a call of the update function."""
        if lateness:
            hours = hours.withWatermark("observed_at", lateness)
        # What an hour's rows are told apart by comes first, in its order.
        ranks = _ranks()
        kinds = {"fetched_at": F.unix_micros("fetched_at"), "temp_c": F.col("temp_c").cast("string"), "day_date": F.unix_date("day_date")}
        fields = [*(name for name, _ in ranks), "lat", "lon"]
        rows = hours.where(F.col("observed_at").isNotNull()).select(
            F.col("lat").cast("string").alias("lat_key"), F.col("lon").cast("string").alias("lon_key"),
            F.window("observed_at", "1 day").alias("w"), "observed_at", "time_epoch", *(kinds.get(c, F.col(c)).alias(c) for c in fields))
        rows = rows.withColumns({"day": F.unix_date(F.to_date("w.start")),
                                 "bucket": F.pmod(F.xxhash64("lat_key", "lon_key"), F.lit(buckets))}).drop("w")
        evict, descending, temp = bool(lateness), [d for _, d in ranks], fields.index("temp_c")

        def newer(row, other):
            """Whether ``row`` comes before ``other`` in the order."""
            for a, b, down in zip(row, other, descending):
                if a != b:
                    return a is not None and (b is None or (a > b) == down)
            return False

        def newest(key, frames, state):
            import pickle
            from decimal import Decimal

            import pandas as pd
            if state.hasTimedOut:
                state.remove()
                return
            windows = pickle.loads(state.get[0]) if state.exists else {}
            touched = {}
            for frame in frames:
                # plain lists: a window's rows are few, and windows are many
                lists = [frame[c].astype(object).where(frame[c].notna(), None).tolist() for c in ("lat_key", "lon_key", "time_epoch", *fields)]
                lists[3 + temp] = [None if t is None else Decimal(t) for t in lists[3 + temp]]
                for lat, lon, epoch, *row in zip(*lists, strict=True):
                    hours = touched[lat, lon] = windows.setdefault((lat, lon), {})
                    if epoch not in hours or newer(row, hours[epoch]):
                        hours[epoch] = row
            state.update((pickle.dumps(windows),))
            if evict:
                state.setTimeoutTimestamp(max((int(key[0]) + 1) * 86_400_000, state.getCurrentWatermarkMs() + 1))
            out = []
            for hours in touched.values():
                total = str(sum(int(row[0] or 0) for row in hours.values()))
                out += [(epoch, *row, len(hours), total) for epoch, row in hours.items()]
            names = ["time_epoch", *fields, "hours", "total"]
            columns = dict(zip(names, zip(*out)))
            yield pd.DataFrame({"time_epoch": columns["time_epoch"], **{c: columns[c] for c in ("city", "country", "lat", "lon")},
                                "temp_c": [None if t is None else format(t, "f") for t in columns["temp_c"]], "fetched": columns["fetched_at"],
                                "hours": columns["hours"], "total": columns["total"]})

        found = rows.groupBy("day", "bucket").applyInPandasWithState(
            newest, "time_epoch bigint, city string, country string, lat double, lon double, temp_c string, fetched bigint, hours bigint, total string",
            "windows binary", "update", GroupStateTimeout.EventTimeTimeout if lateness else GroupStateTimeout.NoTimeout)
        at = F.timestamp_seconds("time_epoch")
        return found.select("city", "country", "lat", "lon", at.alias("observed_at"), F.col("temp_c").cast("decimal(38,9)").alias("temp_c"),
                            "hours", F.col("total").cast("decimal(38,0)").alias("fetched"))

    def append_days(self, batch: DataFrame, _: int = 0) -> None:
        out = fct_weather_daily(batch.withColumn("emitted_at", F.current_timestamp()), PROGRESS)
        _append_once(out, self.days_log, ("city",))

    def _buckets(self, checkpoint: str, choose) -> int:
        """The buckets of the stream at ``checkpoint``: chosen at its first
        start and kept beside the state, which is keyed by them."""
        path = f"{checkpoint}/buckets"
        if not _exists(self.spark, f"{path}/_SUCCESS"):
            choose().write.mode("overwrite").parquet(path)
        return self.spark.read.schema("buckets int").parquet(path).first()[0]

    def _day_buckets(self) -> DataFrame:
        """Buckets for a days stream, by the locations the hours log has on its
        fullest day."""
        log = self._log(self.hours_log, self._hours).where(F.col("day_utc").isNotNull())
        locations = log.groupBy("day_utc").agg(F.approx_count_distinct(F.struct("lat", "lon")).alias("n")).agg(F.max("n").alias("n"))
        return locations.select(F.greatest(F.ceil(F.col("n") / BUCKET_WINDOWS), F.lit(LEAST_BUCKETS)).cast("int").alias("buckets"))

    def start_days(self, checkpoint: str, lateness: str | None = None, available_now: bool = True):
        """STR-4 on the hours log.  Without ``lateness`` windows stay open for
        ever and no late hour is lost.  With it (e.g. '30 days') the state of
        windows behind the watermark is dropped; hours later than that are in
        the hours log only, and ``rebuild_days`` brings them in."""
        self.spark.createDataFrame([], self._hours.schema).write.mode("append").partitionBy("day_utc").parquet(self.hours_log)
        hours = self.spark.readStream.schema(self._hours.schema).parquet(self.hours_log)
        w = (self.windows(hours, lateness, self._buckets(checkpoint, self._day_buckets)).writeStream.outputMode("update").foreachBatch(self.append_days)
             .option("checkpointLocation", checkpoint))
        return (w.trigger(availableNow=True) if available_now else w).start()

    def rebuild_days(self) -> None:
        """Append the mart rows of all windows, from the hours log."""
        self.append_days(self._with_progress(self.hourly().where(F.col("observed_at").isNotNull())))

    # ------------------------------------------------------------- readers

    def _log(self, path: str, empty: DataFrame, *folders: str) -> DataFrame:
        if not _exists(self.spark, path):
            return empty
        return self.spark.read.schema(empty.schema).option("basePath", path).parquet(*(folders or [path])).select(*empty.columns)

    def hourly(self) -> DataFrame:
        """The newest row of every hour; empty before the first batch."""
        return dedup_hours(self._log(self.hours_log, self._hours))

    @staticmethod
    def _last(days: DataFrame) -> DataFrame:
        """Of every window the rows it had when it had come furthest."""
        window = ["lat", "lon", "day_utc"]
        furthest = days.withColumn("top", F.max(F.struct(*PROGRESS)).over(Window.partitionBy(*window)))
        last = furthest.where(F.struct(*PROGRESS) == F.col("top")).drop("top")
        return last.dropDuplicates([*window, "city", "country"])

    def daily(self) -> DataFrame:
        """The daily mart: the days stream's rows, and those of hours without
        a time, which belong to no window, from the hours log."""
        timed = self._last(self._log(self.days_log, self._days))
        untimed = fct_weather_daily(dedup_hours(self._log(self.hours_log, self._hours).where(F.col("day_utc").isNull())))
        return untimed.unionByName(timed.select(*untimed.columns))

    # ---------------------------------------------------------- compaction

    def compact(self, files: int = 16, small: int = 64 << 20) -> int:
        """Rewrite, in both logs, the days of more than ``files`` files of
        under ``small`` bytes on average as one row per key; returns the number
        of files removed.  The new rows are written before the old files go."""
        removed = 0
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        once = {self.hours_log: (self._hours, lambda d: newest_hours(d).withColumn("day_utc", F.to_date("observed_at")), ("lat", "lon")),
                self.days_log: (self._days, self._last, ("city",))}
        for path, (empty, reduce, cluster) in once.items():
            fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
            days = [st.getPath() for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/day_utc=*")) or []]
            crowded = {}
            for day in days:
                parts = [st for st in fs.listStatus(day) if st.getPath().getName().startswith("part-")]
                if len(parts) > files and sum(st.getLen() for st in parts) < small * len(parts):
                    crowded[day.toString()] = [st.getPath() for st in parts]
            if crowded:
                write_partitioned(reduce(self._log(path, empty, *crowded)).select(*empty.columns), path, "day_utc", cluster, mode="append", dynamic=False)
            for part in (p for parts in crowded.values() for p in parts):
                fs.delete(part, False)
                removed += 1
        return removed
