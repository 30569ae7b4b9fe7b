"""Bind the generic driver tables to this data model.

No listening-history export ships with the test data, so plays, user
locations, airports and weather documents are *derived* from the driver's
tables with plain DataFrame expressions.  Every derivation is row-local or a
bounded aggregate, so its cost grows linearly with the input tables.

* ``events``  -> exported plays (bronze text), two snapshots; every tenth
  event is exported again in the second snapshot (known duplicates).
* ``events``  -> three validity intervals per user (overlap + gap planted),
  airport codes ``AP00``..``AP26`` (``AP25``/``AP26`` have no airport).
* ``orders`` x ``customer`` -> one multi-year interval per customer.
* ``nation``  -> airports with made-up coordinates.
* ``events`` x airports -> weather documents (one per year and station).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.operators.joins import sized_broadcast
from histlake.sources.listing import file_system

# Fixed values of the binding (snapshots, interval offsets, station rules).
SNAPSHOT_FIRST = "2024-02-01"
SNAPSHOT_SECOND = "2024-03-01"
DUPLICATE_EVERY = 10
INTERVAL_BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
# (start offset, end offset) in seconds from the base, per interval k = 0, 1, 2
INTERVAL_OFFSETS = [(0, 864000 - 1), (820800, 1728000 - 1), (1814400, 2678400 - 1)]
AIRPORT_CODE_MODULUS = 27
STATION_COUNT = 25
DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_name(user_id: Column) -> Column:
    return F.concat(F.lit("user-"), F.lpad(user_id.cast("string"), 6, "0"))


def airport_code(n: Column) -> Column:
    return F.concat(F.lit("AP"), F.lpad(n.cast("string"), 2, "0"))


def raw_plays(events: DataFrame) -> DataFrame:
    """Events -> bronze rows (all text, 'None'/'nan' as the exporter writes
    JSON nulls).  One scan; the second snapshot comes from an ``explode``."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    k = F.get_json_object("props", "$.k")
    kint = k.cast("int")
    episode = eid % 7 == 0
    secs = F.expr("unix_micros(cast(ts as timestamp)) div 1000000").cast("string")
    none = F.lit("None")
    snapshots = F.when(eid % DUPLICATE_EVERY == 0,
                       F.array(F.lit(SNAPSHOT_FIRST), F.lit(SNAPSHOT_SECOND))
                       ).otherwise(F.array(F.lit(SNAPSHOT_FIRST)))
    return events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        F.when(uid % 4 == 0, "android").when(uid % 4 == 1, "ios")
         .when(uid % 4 == 2, "windows").otherwise("web_player").alias("platform"),
        F.round(F.col("value") * 1000).cast("bigint").cast("string").alias("ms_played"),
        F.upper(F.substring("event_type", 1, 2)).alias("conn_country"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."),
                 (eid % 256).cast("string")).alias("ip_addr"),
        F.when(episode, none).otherwise(F.concat(F.lit("Track "), k)).alias("master_metadata_track_name"),
        F.when(episode, none).otherwise(F.concat(F.lit("Artist "), (kint % 10).cast("string")))
         .alias("master_metadata_album_artist_name"),
        F.when(episode, none).otherwise(F.concat(F.lit("Album - "), (kint % 20).cast("string")))
         .alias("master_metadata_album_album_name"),
        F.when(episode, none).otherwise(F.concat(F.lit("uri:track:"), k)).alias("spotify_track_uri"),
        F.when(episode, F.concat(F.lit("Episode "), k)).otherwise(none).alias("episode_name"),
        F.when(episode, F.concat(F.lit("Show "), (kint % 5).cast("string"))).otherwise(none)
         .alias("episode_show_name"),
        F.when(episode, F.concat(F.lit("uri:episode:"), k)).otherwise(none).alias("spotify_episode_uri"),
        F.when(eid % 3 == 0, "trackdone").when(eid % 3 == 1, "clickrow").otherwise("fwdbtn").alias("reason_start"),
        F.when(eid % 4 == 0, "trackdone").when(eid % 4 == 1, "endplay")
         .when(eid % 4 == 2, "fwdbtn").otherwise("logout").alias("reason_end"),
        F.when(eid % 2 == 0, "True").otherwise("False").alias("shuffle"),
        F.when(eid % 11 == 0, "None").when(eid % 3 == 0, "True").otherwise("False").alias("skipped"),
        F.when(eid % 5 == 0, "True").otherwise("False").alias("offline"),
        F.when(eid % 5 == 0, "nan").when(eid % 13 == 0, F.concat(secs, F.lit(".5")))
         .otherwise(F.concat(secs, F.lit(".0"))).alias("offline_timestamp"),
        F.when(eid % 17 == 0, "True").otherwise("False").alias("incognito_mode"),
        user_name(uid).alias("username"),
        F.explode(snapshots).alias("snapshot_date"),
    )


def user_locations(events: DataFrame) -> DataFrame:
    """Three intervals per user seen in ``events``: [0] and [1] overlap by
    12 h, a one-day gap precedes [2]; all shifted by ``user_id % 24`` hours."""
    users = events.select("user_id").distinct()
    k = F.explode(F.array(*[F.lit(i) for i in range(len(INTERVAL_OFFSETS))])).alias("k")
    starts = F.array(*[F.lit(s) for s, _ in INTERVAL_OFFSETS])
    ends = F.array(*[F.lit(e) for _, e in INTERVAL_OFFSETS])
    shift = F.lit(INTERVAL_BASE_EPOCH) + (F.col("user_id") % 24) * 3600
    return (
        users.select("user_id", k)
        .select(
            user_name(F.col("user_id")).alias("username"),
            F.timestamp_seconds(shift + F.element_at(starts, F.col("k") + 1)).alias("start_at"),
            F.timestamp_seconds(shift + F.element_at(ends, F.col("k") + 1)).alias("end_at"),
            airport_code((F.col("user_id") + F.col("k")) % AIRPORT_CODE_MODULUS).alias("airport_code"),
        )
    )


def customer_locations(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One multi-year interval per customer: first to last order date; the
    airport is the customer's nation."""
    spans = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"))
    cust = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return spans.join(cust, "o_custkey").select(
        F.concat(F.lit("cust-"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("username"),
        F.col("first_at").cast("timestamp").alias("start_at"),
        F.col("last_at").cast("timestamp").alias("end_at"),
        airport_code(F.col("c_nationkey")).alias("airport_code"),
    )


def order_events(orders: DataFrame) -> DataFrame:
    """Orders as events of their customer."""
    return orders.select(F.concat(F.lit("cust-"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("username"),
                         "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("placed_at"))


def priority_intervals(orders: DataFrame) -> DataFrame:
    """Per customer and order priority, the interval from the first to the
    last such order: years long, up to five that overlap."""
    spans = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return spans.select(F.concat(F.lit("cust-"), F.lpad(F.col("o_custkey").cast("string"), 7, "0")).alias("username"),
                        F.col("o_orderpriority").alias("priority"), F.col("a").cast("timestamp").alias("start_at"),
                        F.col("b").cast("timestamp").alias("end_at"))


def airports(nation: DataFrame) -> DataFrame:
    """Nation -> airports (code, latitude, longitude).  Nations n and n+20
    share a latitude."""
    n = F.col("n_nationkey")
    return nation.select(
        airport_code(n).alias("airport_code"),
        ((n % 20).cast("double") * F.lit(2.5) - F.lit(20.0) + F.lit(0.123456)).alias("latitude"),
        (n.cast("double") * F.lit(7.123456) - F.lit(80.0)).alias("longitude"),
    )


def airports_file_frame(nation: DataFrame) -> DataFrame:
    """Airports with the column names of the published airports file."""
    a = airports(nation)
    return a.select(F.col("airport_code").alias("Airport Code"),
                    F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"))


def _stations(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Each event is observed at station ``user_id % 25`` (an airport)."""
    stations = sized_broadcast(airports(nation), max_rows=100_000)
    return events.select(
        "ts", "value", airport_code(F.col("user_id") % STATION_COUNT).alias("airport_code")
    ).join(stations, "airport_code")


def weather_daily_values(events: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per (station, day) with the daily block's values (text time)."""
    s = _stations(events, nation).withColumn("day", F.to_date("ts"))
    g = s.groupBy("latitude", "longitude", "day").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("vmax"))
    t = F.date_format("day", "yyyy-MM-dd")
    return g.select(
        F.year("day").alias("year"),
        F.round("latitude", 3).alias("latitude"),
        F.round("longitude", 3).alias("longitude"),
        t.alias("time"),
        F.when(F.dayofmonth("day") == 13, F.lit(None).cast("double"))
         .otherwise(F.col("n").cast("double")).alias("weather_code"),
        F.concat(t, F.lit("T07:"), F.lpad((F.col("n") % 60).cast("string"), 2, "0")).alias("sunrise"),
        F.concat(t, F.lit("T17:"), F.lpad((F.col("n") % 37).cast("string"), 2, "0")).alias("sunset"),
        (F.col("vmax") * F.lit(100.0)).alias("daylight_duration"),
        F.col("vmax").alias("sunshine_duration"),
    )


def weather_hourly_values(events: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per (station, hour) with the hourly block's values."""
    s = _stations(events, nation).withColumn("hour", F.date_trunc("hour", "ts"))
    g = s.groupBy("latitude", "longitude", "hour").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("vmin"))
    return g.select(
        F.year("hour").alias("year"),
        F.round("latitude", 3).alias("latitude"),
        F.round("longitude", 3).alias("longitude"),
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("vmin").alias("temperature_2m"),
        F.col("n").cast("double").alias("cloud_cover"),
    )


def _field(name: str):
    return lambda x: x.getField(name)


def weather_documents(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Weather replies: one document per (year, latitude, longitude) with
    the daily and hourly blocks as structs of parallel arrays.

    A document covers one calendar year at one coordinate, so its arrays
    hold at most 366 / 8,784 entries whatever the input size; the arrays
    are sorted by time so positions line up across the parallel arrays.
    """
    keys = ["year", "latitude", "longitude"]
    d = weather_daily_values(events, nation)
    h = weather_hourly_values(events, nation)
    dcols = ["time", "weather_code", "sunrise", "sunset", "daylight_duration", "sunshine_duration"]
    hcols = ["time", "temperature_2m", "cloud_cover"]
    daily = d.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*dcols))).alias("a")).select(
        *keys, F.struct(*[F.transform("a", _field(c)).alias(c) for c in dcols]).alias("daily"))
    hourly = h.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*hcols))).alias("a")).select(
        *keys, F.struct(*[F.transform("a", _field(c)).alias(c) for c in hcols]).alias("hourly"))
    return daily.join(hourly, keys, "full")


# Fixed values of the binding: users whose folder names are easily mistaken
# (a number, a blank, a plus sign), and days per exported document.
ODD_USERS = {"user-000007": "007", "user-000008": "ana maria", "user-000009": "c+d"}
DOCUMENT_DAYS = 10
# What is wrong with the second snapshot's documents of users by last digit.
TRUNCATED, BLANK, NO_ARRAY, STRAY = "3", "4", "6", "1"


def export_plays(events: DataFrame) -> DataFrame:
    """Plays under the exporter's user names."""
    name = F.col("username")
    for plain, odd in ODD_USERS.items():
        name = F.when(F.col("username") == plain, odd).otherwise(name)
    return raw_plays(events).withColumn("username", name)


def with_document_names(raw: DataFrame) -> DataFrame:
    """Add ``file_name``: the export document of each play, one per (user,
    snapshot, ten days of a month).  The name follows from the play alone,
    so it does not change when a group grows, and no group is counted."""
    part = F.floor((F.substring("ts", 9, 2).cast("int") - 1) / DOCUMENT_DAYS).cast("string")
    return raw.withColumn("file_name", F.concat(F.lit("history_"), F.substring("ts", 1, 7), F.lit("_"), part, F.lit(".json")))


DOCUMENT_ROWS = 50_000


def with_sized_document_names(raw: DataFrame, rows: int = DOCUMENT_ROWS) -> DataFrame:
    """Add ``file_name``: the export document of each play, one per (user,
    snapshot, month); a group of more than ``rows`` plays is split into
    ceil(n / rows) documents by a hash of the play.  Group sizes come from a
    partial aggregate joined back, null keys too.  A play without time or
    address has no document name."""
    keys = ["username", "snapshot_date", "__month"]
    r = raw.withColumn("__month", F.substring("ts", 1, 7))
    sizes = r.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).alias("__chunks"))
    sizes = sizes.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    h = F.conv(F.substring(F.md5(F.concat("ts", F.lit("|"), "ip_addr")), 1, 8), 16, 10).cast("bigint")
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    return (r.join(sizes, same)
             .withColumn("file_name", F.concat(F.lit("history_"), F.col("__month"), F.lit("_"),
                                               (h % F.col("__chunks")).cast("string"), F.lit(".json")))
             .select(*raw.columns, "file_name"))


def land_exports(raw: DataFrame, root: str, broken: bool = False, by_snapshot: bool = True, notes: bool = False) -> int:
    """Write the export files of ``raw`` and return their number:
    ``<root>/<user>/<snapshot>/<file>`` (or ``<root>/<user>/<file>``), each
    one JSON array.

    The files stand in for the exporter's own, so tasks write them directly:
    rows come sorted by file and go out one by one, no document is ever held
    as a whole, and a task that runs again writes the same bytes.
    ``ms_played`` is a JSON number, the other fields are text.  ``broken``
    spoils documents of the second snapshot by the user's last digit;
    ``notes`` adds a text file per user, which is no export.
    """
    import json

    import pyarrow as pa

    from histlake.schemas import PLAY_COLUMNS
    play = F.to_json(F.struct(*[
        F.col(c).cast("bigint").alias(c) if c == "ms_played" else F.col(c) for c in PLAY_COLUMNS]))
    keys = ["username", "snapshot_date", "file_name"]
    rows = with_document_names(raw).select(*keys, play.alias("play")).repartition(*keys).sortWithinPartitions(*keys, "play")

    def wrong(user: str, snapshot: str) -> str:
        return user[-1:] if broken and snapshot == SNAPSHOT_SECOND and user not in ODD_USERS.values() else ""

    def write(batches):
        target, base = file_system(root)
        base, n, now, out = base.rstrip("/"), 0, None, None

        def close() -> None:
            if out is not None:
                out.write({TRUNCATED: b"", NO_ARRAY: b"]}"}.get(wrong(*now[:2]), b"]") if wrong(*now[:2]) != BLANK else b"")
                out.close()

        for batch in batches:
            for *key, text in zip(*(batch.column(c).to_pylist() for c in [*keys, "play"]), strict=True):
                fault = wrong(key[0], key[1])
                first = key != now
                if first:
                    close()
                    folder = f"{base}/{key[0]}/{key[1]}" if by_snapshot else f"{base}/{key[0]}"
                    target.create_dir(folder, recursive=True)
                    out, now, n = target.open_output_stream(f"{folder}/{key[2]}"), key, n + 1
                    out.write({BLANK: b" \n\t", NO_ARRAY: b'{"plays": [', STRAY: b"[5,\n"}.get(fault, b"["))
                    if notes:
                        with target.open_output_stream(f"{folder}/notes.txt") as f:
                            f.write(json.dumps({"user": key[0]}).encode())
                if fault != BLANK:
                    out.write((b"" if first else b",\n") + text.encode())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    return rows.mapInArrow(write, "files long").agg(F.sum("files")).first()[0] or 0


def document_lines(raw: DataFrame) -> DataFrame:
    """(username, snapshot_date, file_name, body): one document per play, a
    JSON array of one, for the one-document-per-line layout."""
    from histlake.schemas import PLAY_COLUMNS
    obj = F.to_json(F.struct(*[F.col(c).cast("bigint").alias(c) if c == "ms_played" else F.col(c) for c in PLAY_COLUMNS]))
    return with_document_names(raw).select("username", "snapshot_date", "file_name",
                                           F.concat(F.lit("["), obj, F.lit("]")).alias("body"))


# Fixed values of the binding: plays with fields that do not cast, by the
# last part of the address (it is made from the event's number).
BAD_FIELDS = {"13": ("ms_played", "12x"), "77": ("ts", "not a time"), "99": ("shuffle", "maybe"),
              "111": ("offline_timestamp", "soon"), "5": ("offline_timestamp", "1e400"), "6": ("ms_played", "None")}


def dirty_plays(events: DataFrame) -> DataFrame:
    """Plays, some with a field that does not cast to its type."""
    raw = raw_plays(events)
    last = F.substring_index("ip_addr", ".", -1)
    for part, (column, text) in BAD_FIELDS.items():
        raw = raw.withColumn(column, F.when(last == part, text).otherwise(F.col(column)))
    return raw


def previous_watermarks(events: DataFrame, cutoff: str = "2024-01-15") -> DataFrame:
    """Per user, the last play second loaded by an earlier run (plays before
    ``cutoff``); users with ``user_id % 10 == 3`` were never loaded."""
    prior = events.where((F.col("ts") < F.lit(cutoff).cast("timestamp_ntz")) & (F.col("user_id") % 10 != 3))
    return prior.groupBy("user_id").agg(F.max(F.date_trunc("second", "ts")).alias("m")).select(
        user_name(F.col("user_id")).alias("username"), F.col("m").cast("timestamp").alias("max_ts"))


# Fixed value of the binding: snapshot of an early delivery, with the plays before it.
SNAPSHOT_EARLY = "2024-01-16"


def early_delivery(events: DataFrame) -> DataFrame:
    """The first of two deliveries: plays up to its snapshot day."""
    first = export_plays(events).where(F.col("snapshot_date") == SNAPSHOT_FIRST)
    return first.where(F.col("ts") < SNAPSHOT_EARLY).withColumn("snapshot_date", F.lit(SNAPSHOT_EARLY))


def full_delivery(events: DataFrame) -> DataFrame:
    """The second delivery: a full export, old plays too."""
    return export_plays(events).where(F.col("snapshot_date") == SNAPSHOT_FIRST)
