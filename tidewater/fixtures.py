"""Pack the flat driver tables into the nested JSON shapes the reference
ingests.  Every packer is a Spark job over the whole input table.

Groups (a user's day, an order's items, ...) are split into chunks of
about ``max_items`` items (the item's own key, hashed unless it is an
integer id, modulo ``ceil(group size / max_items)``), so a huge group is
spread over many documents and many tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import input_bytes

# Fixed values of the synthetic weather feed.
WEATHER_BASE = "https://api.weather.example/v1/"
HISTORY = "history.json"
FORECAST = "forecast.json"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chunk_of(df: DataFrame, group: list, item_key: str, max_items: int,
             hashed: bool = True) -> DataFrame:
    """Add ``chunk``: ``pmod(key, ceil(n_group / max_items))`` where ``key``
    is ``xxhash64(item_key)`` (``hashed``) or the integer ``item_key`` itself;
    chunks hold ``max_items`` items on average.

    The group sizes come from a partial aggregate (one row per group), joined
    back on the group key; AQE turns that join into a broadcast when the
    measured size of the counts is small and splits skewed partitions
    otherwise.  The result is explicitly hash-partitioned on
    ``(group..., chunk)``: without it Spark would reuse the join's
    partitioning on the group key for the per-chunk aggregation and keep a
    hot group in one task (and AQE could not split the skewed join).
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(max_items)))
    key = F.xxhash64(item_key) if hashed else F.col(item_key)   # integer keys may be used as is
    return (df.join(counts, group)
            .withColumn("chunk", F.pmod(key, n_chunks).cast("int"))
            .drop("__n")
            .repartition(*group, "chunk"))


def user_lat(user) -> "F.Column":
    """Synthetic coordinates: one distinct (lat, lon) per user, tenths of a
    degree, printed identically by every engine."""
    return ((F.pmod(user, F.lit(1200)) - 600).cast("double") / F.lit(10.0))


def user_lon(user) -> "F.Column":
    return ((F.pmod(F.floor(user / F.lit(1200)), F.lit(3600)) - 1800).cast("double") / F.lit(10.0))


def weather_hours(events: DataFrame) -> DataFrame:
    """events -> one weather hour per event (user = location, value = temp,
    props.k = humidity, event_type = condition)."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", "user_id",
        F.to_date(ts).alias("day"),
        F.unix_seconds(ts).alias("time_epoch"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("humidity"),
        F.col("event_type"))


def _render_hours(hours: str, version: str):
    """Hour objects of one delivery.  ``new``: true temperatures, except
    error events whose temperature is the text "n/a" (SAFE_CAST -> NULL);
    ``old``: stale temperatures (value - 100); ``forecast``: value + 1000."""
    def one(h):
        if version == "new":
            temp = F.when(h["event_type"] == "error", F.parse_json(F.lit('"n/a"'))) \
                    .otherwise(h["value"].cast("variant"))
        elif version == "old":
            temp = (h["value"] - 100).cast("variant")
        else:
            temp = (h["value"] + 1000).cast("variant")
        return F.struct(h["time_epoch"].alias("time_epoch"), temp.alias("temp_c"),
                        h["humidity"].alias("humidity"),
                        F.struct(h["event_type"].alias("text")).alias("condition"))
    return F.transform(F.col(hours), one)


def weather_documents(events: DataFrame, max_hours: int = 2048) -> DataFrame:
    """One history document per (user, day, chunk):
    ``{location:{name,country,lat,lon}, forecast:{forecastday:[{date, hour:[...]}]}}``,
    rendered for three deliveries (``doc_new``, ``doc_old``, ``doc_forecast``)."""
    # chunk = event_id mod the number of chunks (reproducible by an oracle);
    # each chunk is a fetch of its own
    h = chunk_of(weather_hours(events), ["user_id", "day"], "event_id", max_hours, hashed=False)
    g = h.groupBy("user_id", "day", "chunk").agg(F.collect_list(
        F.struct("time_epoch", "value", "humidity", "event_type")).alias("hours"))
    loc = F.struct(F.concat(F.lit("City "), F.col("user_id").cast("string")).alias("name"),
                   F.concat(F.lit("Country "), F.pmod("user_id", F.lit(25)).cast("string")).alias("country"),
                   user_lat(F.col("user_id")).alias("lat"), user_lon(F.col("user_id")).alias("lon"))

    def doc(version):
        day = F.struct(F.date_format("day", "yyyy-MM-dd").alias("date"),
                       _render_hours("hours", version).alias("hour"))
        return F.to_json(F.struct(loc.alias("location"),
                                  F.struct(F.array(day).alias("forecastday")).alias("forecast")))

    return g.select("user_id", "day", "chunk", doc("new").alias("doc_new"),
                    doc("old").alias("doc_old"), doc("forecast").alias("doc_forecast"))


def weather_envelopes(events: DataFrame, max_hours: int = 2048) -> DataFrame:
    """Raw weather envelopes ``(raw_json, source_url, fetched_at)``:
    every document is delivered twice (stale copy 1h after the day ends,
    true copy 2h after), plus a newer forecast call with bogus temperatures
    (must be filtered out) and, for every 50th user, a corrupted copy of the
    whole history document (the colon after ``"forecast"`` removed, so it
    does not parse) fetched last (must vanish)."""
    d = weather_documents(events, max_hours)
    # every document is its own fetch: chunks after the first carry &part=N,
    # so their row ids (source_url:fetched_at) differ
    part = F.when(F.col("chunk") > 0, F.concat(F.lit("&part="), F.col("chunk").cast("string"))) \
        .otherwise(F.lit(""))
    q = F.concat(F.lit("?q="), user_lat(F.col("user_id")).cast("string"), F.lit(","),
                 user_lon(F.col("user_id")).cast("string"), F.lit("&dt="),
                 F.date_format("day", "yyyy-MM-dd"), part)
    hist = F.concat(F.lit(WEATHER_BASE + HISTORY), q)
    fore = F.concat(F.lit(WEATHER_BASE + FORECAST), q)
    end = F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")

    def delivery(raw, url, hours_after):
        return F.struct(raw.alias("raw_json"), url.alias("source_url"),
                        (end + F.make_interval(hours=F.lit(hours_after))).alias("fetched_at"))

    # One pass over the packed documents; every document fans out into its
    # deliveries with a single Generate (no union re-running the packing).
    deliveries = F.array(
        delivery(F.col("doc_old"), hist, 1),
        delivery(F.col("doc_new"), hist, 2),
        delivery(F.col("doc_forecast"), fore, 3),
        F.when(F.pmod("user_id", F.lit(50)) == 0,
               delivery(F.replace("doc_new", F.lit('"forecast":'), F.lit('"forecast" ')), hist, 4)))
    return (d.select(F.explode(deliveries).alias("e")).where(F.col("e").isNotNull())
            .select("e.raw_json", "e.source_url", "e.fetched_at"))


# ---------------------------------------------------------------- orders

def order_items(lineitem: DataFrame, max_items: int = 1024) -> DataFrame:
    """Line items as order item structs, grouped per (order, chunk)."""
    li = lineitem.select(
        "l_orderkey",
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                   "l_extendedprice", "l_shipdate").alias("__item"),
        F.struct(F.concat(F.lit("p-"), F.col("l_partkey").cast("string")).alias("product_id"),
                 F.col("l_quantity").cast("bigint").alias("quantity"),
                 F.col("l_extendedprice").alias("unit_price")).alias("item"))
    li = chunk_of(li, ["l_orderkey"], "__item", max_items)
    return li.groupBy("l_orderkey", "chunk").agg(F.collect_list("item").alias("items"))


def orders_nested(orders: DataFrame, lineitem: DataFrame, max_items: int = 1024) -> DataFrame:
    """Typed nested orders ``(order_id, customer_id, order_date, items
    array<struct<product_id, quantity, unit_price>>)``.  Items are grouped
    before the join (one shuffle per side on the order key); orders without
    line items keep an empty array."""
    items = order_items(lineitem, max_items)
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = o.join(items, o.o_orderkey == items.l_orderkey, "left")
    empty = F.array().cast("array<struct<product_id:string,quantity:bigint,unit_price:double>>")
    return j.select(
        F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_date"),
        F.coalesce(F.col("items"), empty).alias("items"))


# ---------------------------------------------------------------- playlists

def playlists_nested(supplier: DataFrame, lineitem: DataFrame, part: DataFrame,
                     max_tracks: int = 1024) -> DataFrame:
    """Typed nested playlists: a supplier is a playlist, its line items are
    tracks titled by the part name; ``(playlist_id, owner_id, title,
    tracks array<struct<track_id, title, duration_sec>>)``."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    p = part.select("p_partkey", "p_name")
    t = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_suppkey",
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey").alias("__item"),
        F.struct(F.concat(F.lit("t-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                          F.col("l_linenumber").cast("string")).alias("track_id"),
                 F.col("p_name").alias("title"),
                 (F.col("l_quantity") * 10).cast("bigint").alias("duration_sec")).alias("track"))
    t = chunk_of(t, ["l_suppkey"], "__item", max_tracks)
    g = t.groupBy("l_suppkey", "chunk").agg(F.collect_list("track").alias("tracks"))
    s = supplier.select("s_suppkey", "s_name", "s_nationkey")
    return s.join(g, s.s_suppkey == g.l_suppkey).select(
        F.concat(F.lit("pl-"), F.col("s_suppkey").cast("string")).alias("playlist_id"),
        F.col("s_nationkey").cast("bigint").alias("owner_id"),
        F.col("s_name").alias("title"), "tracks")


# ---------------------------------------------------------------- sessions

def sessions_documents(events: DataFrame, max_events: int = 1024,
                       max_sessions: int = 256) -> DataFrame:
    """``sessions_json(raw)``: one JSON user document
    ``{user_id, sessions:[{session_id, events:[{event_type, ts}]}]}`` per
    (user, chunk); a session is a user's UTC day.  Every third user's
    documents are wrapped in a one-element array (the sample file's shape).
    Times are text with 6 fraction digits (``to_json`` would cut them)."""
    ts = F.col("ts").cast("timestamp")
    e = events.select(
        "user_id", "event_id", F.to_date(ts).alias("day"),
        F.struct(F.col("event_type"),
                 F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")).alias("ev"))
    e = chunk_of(e, ["user_id", "day"], "event_id", max_events)
    s = e.groupBy("user_id", "day", "chunk").agg(F.collect_list("ev").alias("events"))
    s = s.select("user_id", F.xxhash64("day", "chunk").alias("__sess"),
                 F.struct(F.concat(F.lit("s-"), F.col("user_id").cast("string"), F.lit("-"),
                                   F.date_format("day", "yyyyMMdd")).alias("session_id"),
                          F.col("events")).alias("session"))
    s = chunk_of(s, ["user_id"], "__sess", max_sessions)
    u = s.groupBy("user_id", "chunk").agg(F.collect_list("session").alias("sessions"))
    doc = F.to_json(F.struct(F.col("user_id"), F.col("sessions")))
    return u.select(F.when(F.pmod("user_id", F.lit(3)) == 0, F.concat(F.lit("["), doc, F.lit("]")))
                    .otherwise(doc).alias("raw"))


# ---------------------------------------------------------------- customers

def customer_objects(customer: DataFrame, extra=()) -> DataFrame:
    """customer -> the fields of a customer JSON object (plus ``extra``
    columns passed through)."""
    return customer.select(
        "c_custkey", *extra,
        F.col("c_custkey").alias("id"),
        F.concat(F.col("c_mktsegment"), F.lit(" o'"), F.lower("c_name")).alias("name"),
        F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Example.COM")).alias("email"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("c_custkey", F.lit(365)).cast("int")),
                      "yyyy-MM-dd").alias("signup_date"))


def customer_documents(customer: DataFrame, block: int = 100) -> DataFrame:
    """Clean envelopes: JSON arrays of ``block`` customers ordered by key
    (``raw_json, source, fetched_at``)."""
    c = customer_objects(customer).withColumn("blk", F.floor(F.col("c_custkey") / block))
    g = c.groupBy("blk").agg(F.array_sort(F.collect_list(
        F.struct("id", "name", "email", "signup_date"))).alias("arr"))
    return g.select(F.to_json("arr").alias("raw_json"),
                    F.concat(F.lit("data/customers_"), F.col("blk").cast("string"), F.lit(".json")).alias("source"),
                    F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"))


def customer_documents_dirty(customer: DataFrame, block: int = 100) -> DataFrame:
    """Envelopes for the tolerant path.  By ``c_custkey % 10``:
    1 -> document whose root is the single object, 2 -> id ``"x<id>"``
    (non-numeric), 3 -> bad date ``2024-13-45``, 4 -> name key missing,
    5 -> id as numeric text; the rest in array blocks that also carry the
    non-object items ``42``, ``"oops"``, ``null`` and ``[1]``.  Every 7th
    block adds a NULL document, unparsable text, a scalar root and ``[]``."""
    c = customer_objects(customer)
    k = F.pmod("c_custkey", F.lit(10))
    idtxt = F.col("id").cast("string")
    obj = F.to_json(F.struct(
        F.when(k == 2, F.parse_json(F.concat(F.lit('"x'), idtxt, F.lit('"'))))
         .when(k == 5, F.parse_json(F.concat(F.lit('"'), idtxt, F.lit('"'))))
         .otherwise(F.col("id").cast("variant")).alias("id"),
        F.when(k != 4, F.col("name")).alias("name"),
        F.col("email"),
        F.when(k == 3, F.lit("2024-13-45")).otherwise(F.col("signup_date")).alias("signup_date")))
    c = c.select("c_custkey", k.alias("k"), obj.alias("obj"),
                 F.floor(F.col("c_custkey") / block).alias("blk"))
    single = c.where(F.col("k") == 1).select(
        F.col("obj").alias("raw_json"),
        F.concat(F.lit("data/customer_"), F.col("c_custkey").cast("string"), F.lit(".json")).alias("source"))
    ts = F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at")
    blk = F.col("blk").cast("string")
    # one aggregate pass: every block yields its array document and, for
    # every 7th block, the junk documents (NULL, unparsable, scalar, empty)
    doc = lambda raw, name: F.struct(raw.cast("string").alias("raw_json"), name.alias("source"))
    junk = [doc(F.lit(x), F.concat(F.lit("data/junk_"), blk, F.lit(".json")))
            for x in (None, "{not json", "123", "[]")]
    per_block = c.where(F.col("k") != 1).groupBy("blk").agg(
        F.array_join(F.array_sort(F.collect_list("obj")), ",").alias("items"))
    main = doc(F.concat(F.lit("["), F.col("items"), F.lit(',42,"oops",null,[1]]')),
               F.concat(F.lit("data/customers_"), blk, F.lit(".json")))
    docs = per_block.select(F.explode(F.when(F.pmod("blk", F.lit(7)) == 0, F.array(main, *junk))
                                      .otherwise(F.array(main))).alias("d"))
    return (docs.select("d.raw_json", "d.source", ts)
            .unionByName(single.select("raw_json", "source", ts)))


def customers_semi_raw(customer: DataFrame, deliveries: int = 3) -> DataFrame:
    """Semi-raw customers ``(customer_id, name, email, signup_date string,
    loaded_at)`` delivered ``deliveries`` times with rising ``loaded_at``;
    delivery ``d`` names the customer ``<name> v<d>``."""
    c = customer_objects(customer)
    d = F.explode(F.sequence(F.lit(1), F.lit(deliveries))).alias("d")
    x = c.select("*", d)
    return x.select(
        F.col("id").alias("customer_id"),
        F.concat(F.col("name"), F.lit(" v"), F.col("d").cast("string")).alias("name"),
        F.col("email"), F.col("signup_date"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp")
         + F.make_interval(hours=F.col("d"))).alias("loaded_at"))


# ---------------------------------------------------------------- files

def write_documents(spark: SparkSession, docs: DataFrame, root: str) -> str:
    """Write ``docs(name, text)`` as one file per row named ``root/<name>``
    (a landing folder of JSON documents).  Spark writes the texts in
    parallel; the driver then only renames the part files (metadata)."""
    staging = f"{root}/_staging"
    docs.repartition("name").write.mode("overwrite").partitionBy("name").text(staging)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)
    for st in fs.globStatus(path(f"{staging}/name=*/part-*")):
        name = st.getPath().getParent().getName()[len("name="):]
        fs.rename(st.getPath(), path(f"{root}/{jvm.java.net.URLDecoder.decode(name, 'UTF-8')}"))
    fs.delete(path(staging), True)
    return root


def nation_documents(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Landing documents: one JSON array of nations per region
    (``nations_<REGION>.json``), one object file per nation
    (``nation_<key>.json``) and one broken file (``broken.json``)."""
    r = region.select("r_regionkey", "r_name")
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    per_region = (n.groupBy("n_regionkey")
                  .agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("a"))
                  .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
                  .select(F.concat(F.lit("nations_"), F.col("r_name"), F.lit(".json")).alias("name"),
                          F.to_json("a").alias("text")))
    per_nation = n.select(F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string"), F.lit(".json")).alias("name"),
                          F.to_json(F.struct("n_nationkey", "n_name", "n_regionkey")).alias("text"))
    broken = r.where(F.col("r_regionkey") == 0).select(
        F.lit("broken.json").alias("name"), F.lit('{"n_nationkey": 1, "n_name": ').alias("text"))
    return per_region.unionByName(per_nation).unionByName(broken)


def land_weather_deliveries(spark: SparkSession, events: DataFrame, landing: str,
                            files_per_delivery: int | None = None) -> int:
    """Land the weather envelopes as parquet files in delivery order that is
    *not* fetch order: the newest history copies first, then the stale
    copies, then forecast calls and broken documents.  Returns the number of
    files per delivery (use it as ``maxFilesPerTrigger``): one per 64 MB of
    staged envelopes, and one per core at least."""
    env = weather_envelopes(events)
    staged = f"{landing}_staged"
    env.withColumn("kind", F.hour("fetched_at")).write.mode("overwrite").partitionBy("kind").parquet(staged)
    if files_per_delivery is None:
        files_per_delivery = max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, staged) // (64 << 20)))
    for kinds in ((2,), (1,), (3, 4)):
        part = spark.read.parquet(staged).where(F.col("kind").isin(*kinds)).drop("kind")
        part.repartition(files_per_delivery).write.mode("append").parquet(landing)
    return files_per_delivery
