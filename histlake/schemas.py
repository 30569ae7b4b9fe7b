"""Fixed schemas of the data model (bronze, silver, locations, weather)."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of one exported play, in export order.
PLAY_COLUMNS = [
    "ts", "platform", "ms_played", "conn_country", "ip_addr",
    "master_metadata_track_name", "master_metadata_album_artist_name",
    "master_metadata_album_album_name", "spotify_track_uri", "episode_name",
    "episode_show_name", "spotify_episode_uri", "reason_start", "reason_end",
    "shuffle", "skipped", "offline", "offline_timestamp", "incognito_mode",
]

# The 20 columns whose text forms make up the surrogate key
# (``snapshot_date`` is deliberately left out, ``username`` is in).
KEY_COLUMNS = PLAY_COLUMNS + ["username"]

TEXT_COLUMNS = [
    "platform", "conn_country", "ip_addr",
    "master_metadata_track_name", "master_metadata_album_artist_name",
    "master_metadata_album_album_name", "spotify_track_uri", "episode_name",
    "episode_show_name", "spotify_episode_uri", "reason_start", "reason_end",
]
FLAG_COLUMNS = ["shuffle", "skipped", "offline", "incognito_mode"]
INT_COLUMNS = ["ms_played", "offline_timestamp"]

# Bronze: every exported field as text, plus the two path-derived columns.
BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PLAY_COLUMNS]
    + [T.StructField("username", T.StringType()), T.StructField("snapshot_date", T.StringType())]
)

# What one landing JSON object may hold (all read as text; bronze keeps nulls).
LANDING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PLAY_COLUMNS])


def _typed(name: str) -> T.DataType:
    if name == "ts":
        return T.TimestampType()
    if name in INT_COLUMNS:
        return T.LongType()
    if name in FLAG_COLUMNS:
        return T.BooleanType()
    return T.StringType()


# Silver column order: new key columns first, then the play columns with
# ``ts`` renamed, ``offline_timestamp`` last (it is rebuilt by the clean-up).
SILVER_COLUMNS = (
    ["stream_id", "streamed_year", "streamed_at"]
    + [c for c in PLAY_COLUMNS if c not in ("ts", "offline_timestamp")]
    + ["username", "offline_timestamp"]
)

SILVER_SCHEMA = T.StructType(
    [T.StructField("stream_id", T.StringType()), T.StructField("streamed_year", T.IntegerType()),
     T.StructField("streamed_at", T.TimestampType())]
    + [T.StructField(c, _typed(c)) for c in PLAY_COLUMNS if c not in ("ts", "offline_timestamp")]
    + [T.StructField("username", T.StringType()), T.StructField("offline_timestamp", T.LongType())]
)

USER_LOCATION_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("start_at", T.TimestampType()),
    T.StructField("end_at", T.TimestampType()),
    T.StructField("airport_code", T.StringType()),
])

# The airports file names its columns with capitals and a space.
AIRPORTS_FILE_SCHEMA = T.StructType([
    T.StructField("Airport Code", T.StringType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
])

YEAR_COORDINATES_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("airport_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# Weather document: request coordinates travel with the reply; the two
# blocks are structs of parallel arrays.
WEATHER_DOC_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("weather_code", T.ArrayType(T.DoubleType())),
        T.StructField("sunrise", T.ArrayType(T.StringType())),
        T.StructField("sunset", T.ArrayType(T.StringType())),
        T.StructField("daylight_duration", T.ArrayType(T.DoubleType())),
        T.StructField("sunshine_duration", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("cloud_cover", T.ArrayType(T.DoubleType())),
    ])),
])

WEATHER_PARTITION_COLUMNS = ["year", "latitude", "longitude"]

WEATHER_DAILY_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampType()),
    T.StructField("weather_code", T.DoubleType()),
    T.StructField("sunrise", T.StringType()),
    T.StructField("sunset", T.StringType()),
    T.StructField("daylight_duration", T.DoubleType()),
    T.StructField("sunshine_duration", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

WEATHER_HOURLY_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("cloud_cover", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("full_path", T.StringType()),
    T.StructField("basename", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("snapshot_date", T.DateType()),
])

# What tells one landed file from another.
FILE_KEY = ["username", "snapshot_date", "basename", "size"]
LEDGER_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("snapshot_date", T.StringType()),
    T.StructField("basename", T.StringType()),
    T.StructField("size", T.LongType()),
])

WATERMARK_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("max_ts", T.TimestampType()),
])

# Columns of the binaryFile source, which a stream has to name.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
