"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or data Spark derives from them), runs
one operator or pipeline over the whole tables, and hands back a frame whose
timestamps are ``timestamp_ntz`` wall-clock UTC values so that results can
be compared with a zone-less engine.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histlake.functions.casts import CAST_COLUMNS, cast_rejects, clean_offline_timestamp, counted_casts, typed_plays
from histlake.functions.paths import path_components
from histlake.operators import changes as CH
from histlake.operators import dedup as D
from histlake.operators import incremental as INC
from histlake.operators import profile as PR
from histlake.operators import weather as WX
from histlake.operators import years as Y
from histlake.operators.joins import interval_join, interval_links, overlapping_intervals, sized_broadcast
from histlake.plans import pipelines as P
from histlake.plans.loading import load_new_files
from histlake.schemas import BRONZE_SCHEMA, FLAG_COLUMNS, SILVER_SCHEMA
from histlake.session import configure, scratch_dir, stored
from histlake.sources import bindings as B
from histlake.sources import files as FS
from histlake.sources import landing as LD
from histlake.sources import sinks as SK
from histlake.sources import weather as WS
from histlake.sources.silver_table import SilverTable, unprocessed
from histlake.streaming.bronze_stream import run_available_now
from histlake.streaming.silver_stream import run_silver_stream, take_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def driver_frame(df: DataFrame) -> DataFrame:
    """UTC timestamps -> zone-less ``timestamp_ntz`` (session zone is UTC)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return driver_frame(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


class Tables:
    """Lazy access to the driver tables of one scale-factor folder.

    The shared derivations (table reads, bronze plays, keyed plays, silver)
    are lazy plans, built anew for each query; no data is cached.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in B.DRIVER_TABLES:
            return B.read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def raw_plays(self) -> DataFrame:
        return B.raw_plays(self.events)

    def keyed(self) -> DataFrame:
        return P.keyed_plays(self.raw_plays())

    def silver(self) -> DataFrame:
        return P.silver_streams(self.raw_plays())


# -- C1 / flagship -----------------------------------------------------------

@register("silver_streams")
def q_silver_streams(spark, sf_dir):
    """Bronze -> typed -> keyed -> deduplicated silver."""
    return Tables(spark, sf_dir).silver()


# -- typing and keys (P4, P5, F1, F6) ----------------------------------------


SAMPLE_USER = "user-000007"
CHANGE_COUNTRY = "CL"
CUTOFF = "2024-01-15"
CUTOFF_END = "2024-01-22"


@register("type_cast_streams")
def q_type_cast_streams(spark, sf_dir):
    """Fixed-schema cast of the 21 bronze columns."""
    return typed_plays(Tables(spark, sf_dir).raw_plays())


@register("offline_timestamp_clean")
def q_offline_timestamp_clean(spark, sf_dir):
    """P5: text -> double -> NaN to null -> half-even round -> bigint."""
    raw = Tables(spark, sf_dir).raw_plays()
    return raw.select("username", "ts", "snapshot_date",
                      F.col("offline_timestamp").alias("offline_timestamp_raw"),
                      clean_offline_timestamp("offline_timestamp").alias("offline_timestamp"))


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    """MD5 surrogate key of the 20 key columns."""
    return Tables(spark, sf_dir).keyed().select("username", "ts", "snapshot_date", "stream_id")


@register("streamed_year")
def q_streamed_year(spark, sf_dir):
    """partition year of each silver play."""
    return Tables(spark, sf_dir).silver().select("stream_id", "streamed_at", "streamed_year")


# -- dedup family (W1-W4, U4, U5) --------------------------------------------

@register("dedup_by_stream_id")
def q_dedup_by_stream_id(spark, sf_dir):
    """One row per stream_id, earliest snapshot wins."""
    return P.dedup_by_stream_id(Tables(spark, sf_dir).keyed())


@register("duplicate_members")
def q_duplicate_members(spark, sf_dir):
    """Every row of a stream_id that occurs more than once, with its count."""
    return D.duplicate_rows(Tables(spark, sf_dir).keyed(), ["stream_id"], "count_by_stream_id")


@register("duplicate_surplus")
def q_duplicate_surplus(spark, sf_dir):
    """The rows dedup removes (row number > 1 by snapshot), numbered."""
    return D.numbered_rows(Tables(spark, sf_dir).keyed(), ["stream_id"], ["snapshot_date"],
                           rn_name="rn_by_stream_id", count_name="count_by_stream_id",
                           min_rn=2, only_duplicated=True)


@register("duplicate_ts")
def q_duplicate_ts(spark, sf_dir):
    """Typed rows whose timestamp occurs more than once, with the count."""
    typed = typed_plays(Tables(spark, sf_dir).raw_plays())
    return D.duplicate_rows(typed, ["ts"], "count_by_ts")


@register("dedup_by_ts")
def q_dedup_by_ts(spark, sf_dir):
    """U4: keep the first row per (username, ts)."""
    typed = typed_plays(Tables(spark, sf_dir).raw_plays())
    return D.keep_first(typed, ["username", "ts"], ["snapshot_date"])


# -- changes, filters, sorts (W5, W6, P7-P9, O2, O4) -------------------------

@register("streamed_at_count")
def q_streamed_at_count(spark, sf_dir):
    """Plays per streamed_at, attached to every play."""
    return CH.streamed_at_counts(Tables(spark, sf_dir).silver())


@register("country_change")
def q_country_change(spark, sf_dir):
    """Plays where a user's connection country switched to CL."""
    return CH.country_changes(Tables(spark, sf_dir).silver(), CHANGE_COUNTRY)


@register("country_change_global")
def q_country_change_global(spark, sf_dir):
    """W6 in one order over all users, as where a single user was filtered before."""
    return CH.country_changes(Tables(spark, sf_dir).silver(), CHANGE_COUNTRY, per_user=False)


@register("cutoff_filter_desc")
def q_cutoff_filter_desc(spark, sf_dir):
    """Plays before a cut-off, newest first."""
    s = Tables(spark, sf_dir).silver()
    return s.where(F.col("streamed_at") < F.lit(CUTOFF).cast("timestamp")).orderBy(
        F.desc("streamed_at"), F.desc("stream_id"))


def _stored_bronze(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    SK.write_bronze(Tables(spark, sf_dir).raw_plays(), path)
    return SK.read_bronze(spark, path)


@register("filter_user_snapshot")
def q_filter_user_snapshot(spark, sf_dir):
    """One user's rows of one snapshot; only that folder of the stored
    bronze is read."""
    mine = SK.of_user(_stored_bronze(spark, sf_dir), SAMPLE_USER)
    return mine.where(F.col("snapshot_date") == B.SNAPSHOT_SECOND).drop(SK.BUCKET)


@register("bronze_users_pruned")
def q_bronze_users_pruned(spark, sf_dir):
    """Bronze rows of the users that were ever at one airport; the
    users come from a table, so folders are pruned when the query runs."""
    places = stored(B.user_locations(Tables(spark, sf_dir).events), scratch_dir(spark, "locations"))
    users = places.where(F.col("airport_code") == FILTER_AIRPORT).select("username").distinct()
    return users_plays(_stored_bronze(spark, sf_dir), users).select(*BRONZE_SCHEMA.fieldNames())


def users_plays(bronze: DataFrame, users: DataFrame) -> DataFrame:
    """Stored bronze rows of a set of users, as a join that prunes folders
    when it runs (Spark does so if ``users`` is filtered from a stored table)."""
    return bronze.join(sized_broadcast(SK.with_bucket(users)), ["username", SK.BUCKET], "left_semi")


def _missing_track(raw: DataFrame) -> DataFrame:
    c = F.col("master_metadata_track_name")
    return raw.where(c.isNull() | c.isin("", "None"))


@register("missing_track_filter")
def q_missing_track_filter(spark, sf_dir):
    """Rows whose track name is null, '' or 'None'."""
    return _missing_track(Tables(spark, sf_dir).raw_plays())


@register("missing_track_head")
def q_missing_track_head(spark, sf_dir):
    """Preview, first five missing-track rows by time (a top-k)."""
    m = _missing_track(Tables(spark, sf_dir).raw_plays())
    return m.orderBy("ts", "username", "snapshot_date", "ip_addr", "ms_played").limit(5)


# -- locations, years, coordinates (S8-S10, A1, A2, J1-J6, U1, C3, C5) --------


FILTER_AIRPORT = "AP03"


def _customer_locations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return B.customer_locations(t.orders, t.customer)


@register("year_bounds")
def q_year_bounds(spark, sf_dir):
    """A1: first and last year over all intervals."""
    return Y.year_bounds(_customer_locations(spark, sf_dir))


@register("year_list")
def q_year_list(spark, sf_dir):
    """Consecutive years between the bounds."""
    return Y.year_list(_customer_locations(spark, sf_dir))


@register("user_years_expand")
def q_user_years_expand(spark, sf_dir):
    """(year, username, airport_code) for every year an interval touches."""
    return Y.user_years(_customer_locations(spark, sf_dir)).orderBy("username", "year")


@register("years_code_distinct")
def q_years_code_distinct(spark, sf_dir):
    """Distinct (year, airport_code)."""
    return Y.years_code(_customer_locations(spark, sf_dir))


@register("year_coordinates")
def q_year_coordinates(spark, sf_dir):
    """Distinct (year, airport) with the airport's coordinates."""
    t = Tables(spark, sf_dir)
    return Y.year_coordinates(_customer_locations(spark, sf_dir), B.airports(t.nation))


@register("airports_csv_scan")
def q_airports_csv_scan(spark, sf_dir):
    """S8: ';'-separated airports file, header renamed."""
    path = scratch_dir(spark, "airports")
    FS.write_airports(B.airports_file_frame(Tables(spark, sf_dir).nation), path)
    return FS.read_airports(spark, path)


@register("user_location_csv_scan")
def q_user_location_csv_scan(spark, sf_dir):
    """User-location file with offset timestamps -> UTC."""
    path = scratch_dir(spark, "user-location")
    FS.write_user_locations(B.user_locations(Tables(spark, sf_dir).events), path)
    return FS.read_user_locations(spark, path)


@register("years_csv_roundtrip")
def q_years_csv_roundtrip(spark, sf_dir):
    """Year coordinates written as CSV and read back."""
    t = Tables(spark, sf_dir)
    path = scratch_dir(spark, "years")
    FS.write_year_coordinates(Y.year_coordinates(_customer_locations(spark, sf_dir), B.airports(t.nation)), path)
    return FS.read_year_coordinates(spark, path)


def _play_times(t: Tables) -> DataFrame:
    """User and time of all plays from one scan of three columns."""
    return t.events.select(B.user_name(F.col("user_id")).alias("username"),
                           F.date_trunc("second", "ts").cast("timestamp").alias("streamed_at"))


PAIR_COLUMNS = [*P.LOCATED_COLUMNS, "location_username"]


def _anyones_locations(spark, sf_dir, how, where=None, order=()):
    t = Tables(spark, sf_dir)
    locations = B.user_locations(t.events).withColumnRenamed("username", "location_username")
    plays = t.silver().select(*[c for c in P.SILVER_COLUMNS if c in PAIR_COLUMNS])
    return interval_join(plays, locations if where is None else locations.where(where), "streamed_at", how=how,
                         times=_play_times(t), order=order)


@register("location_interval_join")
def q_location_interval_join(spark, sf_dir):
    """Plays x every interval (of any user) that contains the play's
    time; a play outside all intervals comes once, with nulls.  One row per
    pair, so the result grows with plays times intervals."""
    return _anyones_locations(spark, sf_dir, "left").select(*PAIR_COLUMNS)


@register("location_interval_members")
def q_location_interval_members(spark, sf_dir):
    """Every interval with the segments of time it covers; the linear
    form of J1 (see joins.interval_links)."""
    t = Tables(spark, sf_dir)
    return interval_links(t.silver(), B.user_locations(t.events), "streamed_at", ["stream_id"])[1]


@register("location_interval_filtered")
def q_location_interval_filtered(spark, sf_dir):
    """J1 restricted to one airport (the outer join becomes inner)."""
    found = _anyones_locations(spark, sf_dir, "inner", F.col("airport_code") == FILTER_AIRPORT, ["streamed_at", "stream_id"])
    return found.select(*PAIR_COLUMNS)


@register("location_user_interval_join")
def q_location_user_interval_join(spark, sf_dir):
    """Plays attributed to the same user's intervals (left join)."""
    t = Tables(spark, sf_dir)
    return P.located_plays(t.silver(), B.user_locations(t.events), times=_play_times(t))


@register("location_user_filtered")
def q_location_user_filtered(spark, sf_dir):
    """J2/P10/O1 with the user key: the caller's predicate is a column, with
    a half-open time range; sorted."""
    t = Tables(spark, sf_dir)
    where = ((F.col("airport_code") == FILTER_AIRPORT) & (F.col("streamed_at") >= F.lit(CUTOFF).cast("timestamp"))
             & (F.col("streamed_at") < F.lit(CUTOFF_END).cast("timestamp")))
    return P.located_plays(t.silver(), B.user_locations(t.events), where, _play_times(t)).orderBy("streamed_at", "stream_id")


@register("long_intervals_join")
def q_long_intervals_join(spark, sf_dir):
    """J3 with intervals of years: each order with the intervals (of the
    same customer, from the first to the last order of a priority) it lies in."""
    t = Tables(spark, sf_dir)
    return interval_join(B.order_events(t.orders), B.priority_intervals(t.orders), "placed_at", keys=["username"])


@register("location_overlaps")
def q_location_overlaps(spark, sf_dir):
    """Pairs of a user's intervals that overlap (quality check)."""
    return overlapping_intervals(B.user_locations(Tables(spark, sf_dir).events), ["username"])


# -- weather (S11-S14, P13, J7, J8, A12, C4) ---------------------------------


AS_OF_RECENT = "2024-06-30"
AS_OF_PAST = "1999-06-30"
LOOKUP_STATION = 5  # nation key of the airport looked up


def _landed_documents(spark, sf_dir):
    """Weather replies derived from events, landed as JSON lines, read back."""
    t = Tables(spark, sf_dir)
    path = scratch_dir(spark, "weather-docs")
    WS.write_documents(B.weather_documents(t.events, t.nation), path)
    return WS.read_documents(spark, path)


def _existing_store(docs):
    """The store before a run: daily replies for longitudes above -60,
    hourly replies for longitudes below 60 (some stations lack one or both)."""
    daily = WS.flatten_daily(docs).where(F.col("longitude") > -60.0)
    hourly = WS.flatten_hourly(docs).where(F.col("longitude") < 60.0)
    return daily, hourly


def _weather_requests(spark, sf_dir):
    """Requests from the events-based user locations (year 2024)."""
    t = Tables(spark, sf_dir)
    yc = Y.year_coordinates(B.user_locations(t.events), B.airports(t.nation))
    return WX.request_keys(yc)


@register("weather_daily_flatten")
def q_weather_daily_flatten(spark, sf_dir):
    """Daily block of every document -> rows."""
    return WS.flatten_daily(_landed_documents(spark, sf_dir))


@register("weather_hourly_flatten")
def q_weather_hourly_flatten(spark, sf_dir):
    """Hourly block of every document -> rows."""
    return WS.flatten_hourly(_landed_documents(spark, sf_dir))


HOURLY_COLUMNS = ["datetime", "temperature_2m", "cloud_cover", "year", "latitude", "longitude", "frequency"]


def _written_store(spark, sf_dir):
    docs = _landed_documents(spark, sf_dir)
    root = scratch_dir(spark, "weather-store")
    WS.write_store(WS.flatten_daily(docs), root, WS.DAILY)
    WS.write_store(WS.flatten_hourly(docs), root, WS.HOURLY)
    return root


@register("weather_partitioned_write")
def q_weather_partitioned_write(spark, sf_dir):
    """Both frequencies written under one root, daily subtree read back."""
    return WS.read_store(spark, _written_store(spark, sf_dir), WS.DAILY)


@register("weather_hourly_write")
def q_weather_hourly_write(spark, sf_dir):
    """Both frequencies written under one root, hourly subtree read back."""
    return WS.read_store(spark, _written_store(spark, sf_dir), WS.HOURLY)


@register("weather_partition_lookup")
def q_weather_partition_lookup(spark, sf_dir):
    """Point lookup of one (frequency, year, latitude, longitude)."""
    docs = _landed_documents(spark, sf_dir)
    root = scratch_dir(spark, "weather-store")
    WS.write_store(WS.flatten_daily(docs), root, WS.DAILY)
    lat = (LOOKUP_STATION % 20) * 2.5 - 20.0 + 0.123456
    lon = LOOKUP_STATION * 7.123456 - 80.0
    return WS.lookup(spark, root, WS.DAILY, 2024, lat, lon)


@register("weather_present_semi")
def q_weather_present_semi(spark, sf_dir):
    """Keys present in the daily AND the hourly store."""
    daily, hourly = _existing_store(_landed_documents(spark, sf_dir))
    return WX.present_keys(daily, hourly)


@register("missing_weather_anti")
def q_missing_weather_anti(spark, sf_dir):
    """Requested (year, coordinates) not yet present in both stores."""
    daily, hourly = _existing_store(_landed_documents(spark, sf_dir))
    return WX.missing_requests(_weather_requests(spark, sf_dir), daily, hourly)


@register("weather_completeness")
def q_weather_completeness(spark, sf_dir):
    """Stored rows per partition against the calendar."""
    docs = _landed_documents(spark, sf_dir)
    rows = WS.flatten_daily(docs).select("frequency", *WX.KEYS).unionByName(
        WS.flatten_hourly(docs).select("frequency", *WX.KEYS))
    return WX.completeness(rows)


@register("weather_request_window")
def q_weather_request_window(spark, sf_dir):
    """Skip future years, clamp the end date to the as-of date."""
    t = Tables(spark, sf_dir)
    yc = Y.year_coordinates(_customer_locations(spark, sf_dir), B.airports(t.nation))
    return WX.request_window(WX.request_keys(yc), AS_OF_PAST)


def _fetched_store(spark, sf_dir, force=False):
    """C4: requests -> window -> missing -> flatten landed replies -> store;
    the store's root and the requested keys."""
    docs = _landed_documents(spark, sf_dir)
    root = scratch_dir(spark, "weather-store")
    daily0, hourly0 = _existing_store(docs)
    WS.write_store(daily0, root, WS.DAILY)
    WS.write_store(hourly0, root, WS.HOURLY)
    requests = WX.request_window(_weather_requests(spark, sf_dir), AS_OF_RECENT)
    missing = WX.missing_requests(requests, WS.read_store(spark, root, WS.DAILY),
                                  WS.read_store(spark, root, WS.HOURLY), force=force).select(*WX.KEYS).distinct()
    # the key set is read from the store that is about to be overwritten
    missing = stored(missing, scratch_dir(spark, "weather-missing"))
    fetched = docs.withColumn("latitude", F.round("latitude", 3)).withColumn(
        "longitude", F.round("longitude", 3)).join(missing, WX.KEYS, "left_semi")
    WS.write_store(WS.flatten_daily(fetched), root, WS.DAILY)
    WS.write_store(WS.flatten_hourly(fetched), root, WS.HOURLY)
    return root, missing


@register("weather_store_roundtrip")
def q_weather_store_roundtrip(spark, sf_dir):
    """C4: the newly stored daily rows, read back."""
    root, missing = _fetched_store(spark, sf_dir)
    return WS.read_store(spark, root, WS.DAILY).join(missing, WX.KEYS, "left_semi")


@register("weather_store_hourly")
def q_weather_store_hourly(spark, sf_dir):
    """C4: all hourly rows after the newly fetched ones were stored."""
    return WS.read_store(spark, _fetched_store(spark, sf_dir)[0], WS.HOURLY)


@register("weather_store_forced")
def q_weather_store_forced(spark, sf_dir):
    """C4/J7 with ``force``: all requests are fetched again, stored or not;
    the daily rows of the requested keys."""
    root, wanted = _fetched_store(spark, sf_dir, force=True)
    return WS.read_store(spark, root, WS.DAILY).join(wanted, WX.KEYS, "left_semi")


# -- profiles (A3-A9) --------------------------------------------------------


CATEGORY_COLUMNS = ["conn_country", "reason_start", "reason_end"]


def _typed(spark, sf_dir):
    return typed_plays(Tables(spark, sf_dir).raw_plays())


@register("category_counts")
def q_category_counts(spark, sf_dir):
    """A3: value frequencies of country / reason_start / reason_end."""
    return PR.category_counts(_typed(spark, sf_dir), CATEGORY_COLUMNS)


@register("flag_value_counts")
def q_flag_value_counts(spark, sf_dir):
    """A4: value counts of each flag, nulls dropped."""
    return PR.value_counts(_typed(spark, sf_dir), FLAG_COLUMNS)


@register("missing_counts")
def q_missing_counts(spark, sf_dir):
    """A5: missing values (null, '', 'None', 'nan') per bronze column."""
    return PR.missing_counts(Tables(spark, sf_dir).raw_plays())


@register("rounding_diff_sum")
def q_rounding_diff_sum(spark, sf_dir):
    """Sum of rounding differences of offline_timestamp."""
    return PR.rounding_diff(Tables(spark, sf_dir).raw_plays(), "offline_timestamp")


@register("numeric_profile")
def q_numeric_profile(spark, sf_dir):
    """Numeric describe of ms_played and offline_timestamp."""
    p = PR.numeric_profile(_typed(spark, sf_dir), ["ms_played", "offline_timestamp"])
    return p.select(*[F.round(c, 4).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else c for c in p.columns])


@register("timestamp_profile")
def q_timestamp_profile(spark, sf_dir):
    """Timestamp describe of ts and snapshot_date."""
    return PR.timestamp_profile(_typed(spark, sf_dir), ["ts", "snapshot_date"])


@register("string_profile")
def q_string_profile(spark, sf_dir):
    """Count / unique / top / freq of all 21 bronze columns."""
    return PR.string_profile(Tables(spark, sf_dir).raw_plays(), BRONZE_SCHEMA.fieldNames())


# -- bronze layer, sinks, incremental (S1-S5, S7, S16, C2, X1-X3) ------------


PROCESSED_AT = _dt.datetime(2024, 12, 10, 12, 0, 0)


def _landed(spark, sf_dir, broken=False):
    """The exporter's files: <root>/<user>/<snapshot>/<file>.json."""
    root = scratch_dir(spark, "landing")
    B.land_exports(B.export_plays(Tables(spark, sf_dir).events), root, broken)
    return root


@register("bronze_json_scan")
def q_bronze_json_scan(spark, sf_dir):
    """Plays of all landed documents that can be read, as text
    rows with user, snapshot and file from the path; some documents are broken."""
    return LD.read_landing(spark, _landed(spark, sf_dir, broken=True)).plays


@register("landing_rejects")
def q_landing_rejects(spark, sf_dir):
    """Documents and array elements that are no plays, with the reason."""
    rejects = LD.read_landing(spark, _landed(spark, sf_dir, broken=True)).rejects
    return rejects.select(*LD.PATH_COLUMNS, "reason", "position")


@register("landing_counts")
def q_landing_counts(spark, sf_dir):
    """Documents, plays and rejects by reason, counted while the
    plays were written to bronze."""
    exports = LD.read_landing(spark, _landed(spark, sf_dir, broken=True))
    SK.write_bronze(exports.plays, scratch_dir(spark, "bronze"))
    return spark.createDataFrame(sorted(exports.counts.get.items()), "metric string, n long")


@register("bronze_lines_scan")
def q_bronze_lines_scan(spark, sf_dir):
    """S1 for the layout with one document per line (splittable files)."""
    root = scratch_dir(spark, "landing-lines")
    LD.write_landing(B.document_lines(B.export_plays(Tables(spark, sf_dir).events)), root)
    return LD.read_landing(spark, root, "lines").plays


@register("path_components")
def q_path_components(spark, sf_dir):
    """User / snapshot / file of the landed files' paths, and of the
    same paths cut to their last parts (default and strict off-by-one rule;
    users ending in 5 get a bare 3-part path)."""
    files = LD.export_files(spark, _landed(spark, sf_dir), content=False)
    tail = F.concat_ws("/", F.slice(F.split("path", "/"), -3, 3))
    bare = F.substring("username", -1, 1) == "5"
    p = files.select("username", "snapshot_date", "file_name",
                     F.when(bare, tail).otherwise(F.concat(F.lit("raw/"), tail)).alias("path"))
    c, s = path_components(F.col("path")), path_components(F.col("path"), strict=True)
    return p.select("username", "snapshot_date", "file_name", "path", c["username"].alias("cut_username"),
                    c["bad_path"].alias("bad_path"), s["username"].alias("strict_username"), s["bad_path"].alias("strict_bad_path"))


@register("file_manifest")
def q_file_manifest(spark, sf_dir):
    """The drop folder's files (user, base name, processing time;
    the snapshot is the day of modification); other files are left out."""
    root = scratch_dir(spark, "drop")
    first = B.export_plays(Tables(spark, sf_dir).events).where(F.col("snapshot_date") == B.SNAPSHOT_FIRST)
    B.land_exports(first, root, by_snapshot=False, notes=True)
    m = LD.file_manifest(spark, root, PROCESSED_AT)
    return m.select("username", "basename", "processed_at",
                    F.col("full_path").endswith(F.concat(F.lit("/"), "username", F.lit("/"), "basename")).alias("path_fits"),
                    (F.col("snapshot_date") == F.to_date("created_at")).alias("snapshot_fits"))


@register("bronze_partitioned_write")
def q_bronze_partitioned_write(spark, sf_dir):
    """Bronze written twice (idempotent overwrite), read back."""
    raw = Tables(spark, sf_dir).raw_plays()
    path = scratch_dir(spark, "bronze")
    SK.write_bronze(raw, path)
    SK.write_bronze(raw, path)
    return SK.read_bronze(spark, path).drop(SK.BUCKET)


@register("bronze_per_file_write")
def q_bronze_per_file_write(spark, sf_dir):
    """One output folder per source file, read back with the file name."""
    raw = B.with_sized_document_names(Tables(spark, sf_dir).raw_plays()).withColumnRenamed("file_name", "source_file")
    path = scratch_dir(spark, "bronze-files")
    SK.write_bronze_files(raw, path, "source_file")
    return SK.read_bronze_files(spark, path, "source_file")


@register("bronze_roundtrip")
def q_bronze_roundtrip(spark, sf_dir):
    """Landing JSON -> bronze Parquet (partitioned) -> read back."""
    rows = LD.read_landing(spark, _landed(spark, sf_dir)).plays.drop("file_name")
    path = scratch_dir(spark, "bronze")
    SK.write_bronze(rows, path)
    return SK.read_bronze(spark, path).drop(SK.BUCKET)


@register("silver_partitioned_write")
def q_silver_partitioned_write(spark, sf_dir):
    """Silver written twice by (username, streamed_year), read back."""
    silver = stored(Tables(spark, sf_dir).silver(), scratch_dir(spark, "silver-rows"))
    path = scratch_dir(spark, "silver")
    SK.write_silver(silver, path)
    SK.write_silver(silver, path)
    return SK.read_silver(spark, path)


def _null_keys(silver):
    """Some plays without a user, without a year, or without both."""
    part = F.substring("stream_id", 1, 1)
    return (silver.withColumn("username", F.when(~part.isin("0", "1"), F.col("username")))
            .withColumn("streamed_year", F.when(~part.isin("1", "2"), F.col("streamed_year"))))


@register("incremental_silver_merge")
def q_incremental_silver_merge(spark, sf_dir):
    """Increments merged into an absent folder, then into it, the
    second one again; plays without user or year too; equal to one load of all."""
    silver = _null_keys(stored(Tables(spark, sf_dir).silver(), scratch_dir(spark, "silver")))
    path = scratch_dir(spark, "silver-merged")
    even = F.conv(F.substring("stream_id", -1, 1), 16, 10).cast("int") % 2 == 0
    SK.merge_silver(silver.where(even), path)
    for _ in range(2):
        SK.merge_silver(silver.where(~even | (F.substring("stream_id", -1, 1) == "2")), path)
    return SK.read_silver(spark, path)


def _two_deliveries(spark, sf_dir):
    """A silver table after three runs over a landing zone that grew once."""
    t = Tables(spark, sf_dir)
    landing = scratch_dir(spark, "landing")
    table = SilverTable(spark, scratch_dir(spark, "silver-table"))
    B.land_exports(B.early_delivery(t.events), landing)
    load_new_files(spark, landing, table, "run-1")
    B.land_exports(B.full_delivery(t.events), landing)
    load_new_files(spark, landing, table, "run-2")
    load_new_files(spark, landing, table, "run-3")
    return table


@register("incremental_three_runs")
def q_incremental_three_runs(spark, sf_dir):
    """State after three runs (early plays, a full export, nothing
    new): files and plays per user, watermark, last batch."""
    table = _two_deliveries(spark, sf_dir)
    files = table.ledger().groupBy("username").agg(F.count(F.lit(1)).alias("n_files"), F.max("batch").alias("last_batch"))
    plays = table.plays().groupBy("username").agg(F.count(F.lit(1)).alias("n_plays"))
    return files.join(plays, "username").join(table.watermarks(), "username")


@register("incremental_ledger")
def q_incremental_ledger(spark, sf_dir):
    """The ledger of files after three runs, with the batch of each."""
    return _two_deliveries(spark, sf_dir).ledger().drop("size")


@register("stream_silver_increments")
def q_stream_silver_increments(spark, sf_dir):
    """Landing -> silver as a stream.  Two deliveries (the second exports
    plays again), small micro-batches, a run without new files, the last
    batch replayed: equal to one load of everything."""
    raw = B.export_plays(Tables(spark, sf_dir).events)
    landing, root, ck = (scratch_dir(spark, n) for n in ("landing", "silver-stream", "silver-stream-ckpt"))
    B.land_exports(raw.where(F.col("snapshot_date") == B.SNAPSHOT_FIRST), landing)
    run_silver_stream(spark, landing, root, ck)
    B.land_exports(raw.where(F.col("snapshot_date") == B.SNAPSHOT_SECOND), landing)
    table = run_silver_stream(spark, landing, root, ck)
    run_silver_stream(spark, landing, root, ck)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    take_batch(root)(files, 1)                    # the stream's own id: skipped
    take_batch(root, "again")(files, 0)           # another name: nothing new
    return table.plays()


@register("external_table")
def q_external_table(spark, sf_dir):
    """A catalog table over the silver Parquet folder."""
    path = scratch_dir(spark, "silver")
    SK.write_silver(Tables(spark, sf_dir).silver(), path)
    name = SK.external_table(spark, path, partitioned_by=tuple(SK.SILVER_FOLDERS), schema=SK.SILVER_TABLE_SCHEMA)
    return spark.table(name).select(*SILVER_SCHEMA_COLUMNS)


SILVER_SCHEMA_COLUMNS = P.SILVER_COLUMNS


def _watermark_run(spark, sf_dir):
    t = Tables(spark, sf_dir)
    batch = typed_plays(t.raw_plays())
    return INC.watermark_load(batch, B.previous_watermarks(t.events))


@register("incremental_watermark_load")
def q_incremental_watermark_load(spark, sf_dir):
    """Plays newer than each user's watermark, one per (user, ts)."""
    return _watermark_run(spark, sf_dir)[0]


@register("incremental_new_watermarks")
def q_incremental_new_watermarks(spark, sf_dir):
    """The advanced per-user watermarks."""
    return _watermark_run(spark, sf_dir)[1]


@register("unprocessed_files_anti")
def q_unprocessed_files_anti(spark, sf_dir):
    """Landed files that are not in the ledger of a table that has taken
    in the first snapshot of users ending in an even digit.  Base names are
    the same in both snapshots."""
    root = _landed(spark, sf_dir)
    listing = LD.export_files(spark, root, content=False).withColumn("basename", F.col("file_name"))
    seen = listing.where((F.col("snapshot_date") == B.SNAPSHOT_FIRST)
                         & F.substring("username", -1, 1).isin("0", "2", "4", "6", "8"))
    return unprocessed(listing, seen).select("username", "snapshot_date", "basename")


@register("stream_bronze_available_now")
def q_stream_bronze_available_now(spark, sf_dir):
    """Landing -> bronze with Structured Streaming, run twice (the second
    run finds no new file), bronze read back."""
    root = _landed(spark, sf_dir)
    out = scratch_dir(spark, "bronze-stream")
    ck = scratch_dir(spark, "bronze-stream-ckpt")
    run_available_now(spark, root, out, ck)
    run_available_now(spark, root, out, ck)
    return SK.read_bronze(spark, out, ("file_name",)).drop(SK.BUCKET)


@register("silver_streams_compat")
def q_silver_streams_compat(spark, sf_dir):
    """C1 in compatibility mode: a flag is True for any non-empty text (the
    exporter's string-to-bool rule), so plays differing only in flags merge."""
    return P.silver_streams(Tables(spark, sf_dir).raw_plays(), compat_booleans=True)


@register("missing_weather_complete")
def q_missing_weather_complete(spark, sf_dir):
    """J7 in ``complete`` mode: a key counts as present only with the full
    calendar of daily and hourly rows (a partly fetched year is re-requested)."""
    daily, hourly = _existing_store(_landed_documents(spark, sf_dir))
    return WX.missing_requests(_weather_requests(spark, sf_dir), daily, hourly, mode="complete")


@register("dedup_sql")
def q_dedup_sql(spark, sf_dir):
    """The dedup in SQL over a registered view, with a named WINDOW
    clause: a row stays if it equals the least row of its key."""
    view = f"exports_{uuid.uuid4().hex[:8]}"
    keyed = Tables(spark, sf_dir).keyed()
    keyed.createOrReplaceTempView(view)
    rest = [c for c in keyed.columns if c not in ("stream_id", "snapshot_date")]
    row = f"struct(snapshot_date, {', '.join(rest)})"
    return spark.sql(f"""
        SELECT DISTINCT 1 AS rn_by_stream_id, stream_id, earliest.*
        FROM (SELECT stream_id, min({row}) OVER one_key AS earliest FROM {view}
              WINDOW one_key AS (PARTITION BY stream_id))""")


@register("cast_counts")
def q_cast_counts(spark, sf_dir):
    """Missing and failed fields per column, counted while the typed
    plays were written."""
    typed, counts = counted_casts(B.dirty_plays(Tables(spark, sf_dir).events))
    stored(typed, scratch_dir(spark, "typed"))
    got = counts.get
    return spark.createDataFrame([(c, got["rows"], got[f"{c}.missing"], got[f"{c}.failed"]) for c in CAST_COLUMNS],
                                 "column_name string, n_rows long, n_missing long, n_failed long")


@register("cast_rejects")
def q_cast_rejects(spark, sf_dir):
    """Every field that does not cast, with its play and text."""
    return cast_rejects(B.dirty_plays(Tables(spark, sf_dir).events))


@register("duplicate_profile")
def q_duplicate_profile(spark, sf_dir):
    """A9 over the duplicate set: profile of all rows whose key occurs more than once."""
    dups = D.duplicate_rows(Tables(spark, sf_dir).keyed(), ["stream_id"], "n").drop("n", "stream_id")
    return PR.string_profile(dups.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")), BRONZE_SCHEMA.fieldNames())
