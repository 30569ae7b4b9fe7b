"""Change detection over a timeline: lag / lead over segments.

``lag(v) over (partition by p order by o)`` sends every row of one ``p`` to
one task, which breaks when one user holds a third of all plays; without
``p`` all rows go to one.  Here the rows are cut into segments of the order
(:mod:`histlake.operators.segments`), so a heavy user is spread over as many
tasks as its share asks for, in a single busy day too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.operators.dedup import key_counts, with_key_count
from histlake.operators.segments import neighbours, segmented
from histlake.session import scratch_dir, stored

CHANGE_COLUMNS = ["stream_id", "username", "streamed_at", "conn_country"]


def lag_lead(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
             lag_name: str, lead_name: str, segments: int | None = None) -> DataFrame:
    """Add ``lag_name`` / ``lead_name`` = previous / next ``value`` by ``order``
    inside ``partition`` (none: over all rows).  ``order`` must be a total
    order within a partition; null keys are a partition of their own."""
    seg = segmented(df, [*partition, *order], segments)
    return neighbours(seg, partition, order, value, lag_name, lead_name)


def country_changes(silver: DataFrame, country: str, per_user: bool = True) -> DataFrame:
    """Plays where the connection country switched *to* ``country``: stream_id,
    username, streamed_at, conn_country, the countries before and after, and
    the number of the user's plays at that time.

    ``lag <> country`` is false for a user's first play (null comparison),
    so that play is never reported, as in plain SQL.
    """
    # four columns are stored once for the two readers
    plays = stored(silver.select(*CHANGE_COLUMNS), scratch_dir(silver.sparkSession, "changes"))
    part = ["username"] if per_user else []
    ll = lag_lead(plays, part, ["streamed_at", "stream_id"], "conn_country", "lag_conn_country", "lead_conn_country")
    ll = ll.where((F.col("lag_conn_country") != F.col("conn_country")) & (F.col("conn_country") == country))
    counts = key_counts(plays, ["username", "streamed_at"], "count_by_streamed_at")
    counts = counts.withColumnsRenamed({"username": "__user", "streamed_at": "__at"})
    same = [ll["username"].eqNullSafe(counts["__user"]), ll["streamed_at"].eqNullSafe(counts["__at"])]
    return ll.join(counts, same).drop("__user", "__at").orderBy("streamed_at", "stream_id")


def streamed_at_counts(silver: DataFrame) -> DataFrame:
    """stream_id, streamed_at and the number of the user's plays at that time."""
    plays = stored(silver.select("stream_id", "username", "streamed_at"), scratch_dir(silver.sparkSession, "times"))
    return with_key_count(plays, ["username", "streamed_at"], "count_by_streamed_at").select(
        "stream_id", "streamed_at", "count_by_streamed_at")
