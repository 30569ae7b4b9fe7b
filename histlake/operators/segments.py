"""Operators over one long order, cut into segments.

``sum() over (order by ...)``, ``lag`` and ``lead`` send all rows of a window
partition to one task: with no partition column the whole table, with one a
heavy user.  Here the rows are range-partitioned by the full order instead
and stored once, so a *segment* (one range partition) holds about
``rows / segments`` rows whoever they belong to, and its limits stay fixed
when a task runs again.  A window then runs inside each segment, and what
crosses a segment's edge comes from a table with one row per segment:

* running totals: the sum of all earlier segments,
* lag / lead: the last row before and the first row after the segment.

The edge table has as many rows as there are segments (shuffle partitions),
so its own window is small and it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histlake.session import scratch_dir, stored

SEGMENT = "__segment"


def segmented(df: DataFrame, order: Sequence[str], segments: int | None = None) -> DataFrame:
    """``df`` stored in range partitions of ``order``, with their number.

    Rows that are equal in ``order`` share a segment: let ``order`` end in
    columns that tell rows apart."""
    spark = df.sparkSession
    n = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn(SEGMENT, F.spark_partition_id())
    return stored(ranged, scratch_dir(spark, "segments"))


def running_totals(seg: DataFrame, order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Adds, per ``name: column`` of ``values``, the sum of the column over
    all rows up to and with this one by ``order`` (rows equal in ``order`` in
    no fixed order)."""
    inside = Window.partitionBy(SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = seg.groupBy(SEGMENT).agg(*[F.sum(c).alias(f"__sum_{name}") for name, c in values.items()])
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(SEGMENT, *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in values])
    out = seg.select("*", *[F.sum(c).over(inside).alias(name) for name, c in values.items()]).join(F.broadcast(offsets), SEGMENT)
    for name in values:
        out = out.withColumn(name, F.col(name) + F.col(f"__before_{name}"))
    return out.drop(*[f"__before_{n}" for n in values])


def neighbours(seg: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
               lag_name: str, lead_name: str) -> DataFrame:
    """Adds the previous and next ``value`` by ``order`` among the rows of
    the same ``partition`` (null keys are equal to each other).

    ``seg`` is segmented by ``[*partition, *order]``, so rows of one
    partition value are in neighbouring segments and the row before a
    segment's first one is the last row of the nearest segment before it.
    """
    part = list(partition)
    inside = Window.partitionBy(SEGMENT).orderBy(*part, *order)
    row = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(part)], F.col(value).alias("v"))
    place = F.struct(*[F.col(c) for c in (*part, *order)])

    edges = seg.groupBy(SEGMENT).agg(F.min_by(row, place).alias("__first"), F.max_by(row, place).alias("__last"))
    by_segment = Window.orderBy(SEGMENT)
    edges = edges.select(SEGMENT, F.lag("__last").over(by_segment).alias("__before"),
                         F.lead("__first").over(by_segment).alias("__after"))

    out = (seg.withColumn("__lag", F.lag(row).over(inside)).withColumn("__lead", F.lead(row).over(inside))
           .join(F.broadcast(edges), SEGMENT))
    for name, near, beyond in ((lag_name, "__lag", "__before"), (lead_name, "__lead", "__after")):
        found = F.coalesce(near, beyond)         # only a segment's edge row has no neighbour inside
        same = F.lit(True)
        for i, c in enumerate(part):
            same = same & found[f"p{i}"].eqNullSafe(F.col(c))
        out = out.withColumn(name, F.when(found.isNotNull() & same, found["v"]))
    return out.drop("__lag", "__lead", "__before", "__after", SEGMENT)


