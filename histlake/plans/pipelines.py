"""Composite pipelines (the user-level API).

C1 ``silver_streams``: bronze text -> typed -> keyed -> deduplicated silver.
One lazy chain; the only shuffle is the one on ``stream_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.functions.casts import typed_plays
from histlake.functions.keys import surrogate_key
from histlake.operators.dedup import keep_first
from histlake.operators.joins import interval_join
from histlake.schemas import SILVER_COLUMNS

__all__ = ["LOCATED_COLUMNS", "SILVER_COLUMNS", "dedup_by_stream_id", "keyed_plays", "located_plays", "silver_streams",
           "to_silver_columns"]


def keyed_plays(bronze: DataFrame, compat_booleans: bool = False) -> DataFrame:
    """Typed plays with their ``stream_id`` (still one row per exported play)."""
    return surrogate_key(typed_plays(bronze, compat_booleans), "ts")


def to_silver_columns(keyed: DataFrame) -> DataFrame:
    """Keyed plays -> silver column set: ``ts`` becomes ``streamed_at``, the
    partition year is added, ``snapshot_date`` is dropped."""
    cols = []
    for c in SILVER_COLUMNS:
        if c == "streamed_year":
            cols.append(F.year("ts").cast("int").alias(c))
        elif c == "streamed_at":
            cols.append(F.col("ts").alias(c))
        else:
            cols.append(F.col(c))
    return keyed.select(*cols)


def dedup_by_stream_id(keyed: DataFrame) -> DataFrame:
    """One row per ``stream_id``; the earliest snapshot survives (all other
    columns break ties, so the survivor is deterministic)."""
    return keep_first(keyed, ["stream_id"], ["snapshot_date"])


def silver_streams(bronze: DataFrame, compat_booleans: bool = False) -> DataFrame:
    return to_silver_columns(dedup_by_stream_id(keyed_plays(bronze, compat_booleans)))


#: Columns of a play with its place.
LOCATED_COLUMNS = ["stream_id", "username", "streamed_at", "ms_played", "ip_addr", "conn_country",
                   "start_at", "end_at", "airport_code", "master_metadata_track_name",
                   "master_metadata_album_artist_name"]


def located_plays(silver: DataFrame, locations: DataFrame, where: Column | None = None,
                  times: DataFrame | None = None) -> DataFrame:
    """Plays with the place their user was at (left join: plays without
    one stay, unless ``where``, a condition on the joined rows, asks for it)."""
    return interval_join(silver, locations, "streamed_at", keys=["username"], times=times, where=where).select(*LOCATED_COLUMNS)
