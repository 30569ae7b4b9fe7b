"""Join helpers: size-checked broadcast and interval joins.

Interval join (``ts BETWEEN start AND end``, both ends inclusive)
----------------------------------------------------------------
Spark has no range-join strategy: a bare non-equi condition plans as a
nested-loop join.  :func:`interval_join` turns it into two equi-joins:

1. *touched buckets* (key, day) in which there are events at all are joined
   to the intervals that reach into them.  An interval is filed under two
   coarse buckets at most, on the level (days, 8 days, 64 days, ...) that fits
   its length, and a touched bucket looks up one coarse bucket per level in
   use.  An interval of ten years is two rows, not 3,653;
2. events meet the intervals of their own (key, day), the range test is a
   residual condition of that join.

An event lies in one bucket, so each matching interval is found once and an
unmatched event of a left join comes back once with nulls.  The result of
step 1 has at most one row per touched bucket and interval that covers it, so
days without events cost nothing.  AQE splits a hot (key, day) on the event
side and broadcasts step 1 where it is small.

Without a key there are as many (key, day) as days, each with a large share of
a result that is many times its inputs.  So there step 1 is broadcast if it is
within the bounds, and events are dealt evenly over tasks; beyond the bounds a
day is dealt over ``SHARES`` shares, each with all of the day's intervals.  A
result in the order of event columns comes from sorted events: a broadcast
keeps their order, the pairs are not sorted.

Links of all users (no key)
---------------------------
Without a key every event meets the intervals of all users, and the result
grows with their product.  :func:`interval_links` keeps it linear: the ends
of all intervals cut time into elementary segments, inside which the set of
covering intervals does not change.  An event gets the number of its segment
and how many intervals cover it (a running total over events and ends), an
interval the first and last segment it covers.  Event and interval are linked
if the one's segment is within the other's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histlake.session import scratch_dir, stored


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of one row: texts by length, the rest by kind."""
    total = F.lit(0)
    for f in df.schema:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            total = total + F.greatest(F.size(F.col(f.name)), F.lit(0)) * 16 + 16
        else:
            total = total + 8
    return total


def sized_broadcast(df: DataFrame, max_rows: int = 500_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast ``df`` only if it provably is within both bounds.

    One aggregate counts rows and bytes, so use it for small inputs (a
    dimension file, a stored state table).  Beyond a bound the frame comes
    back as it is and is joined by a shuffle.  For a side derived from a
    large table leave the choice to AQE, which knows the shuffled size.
    """
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["b"] <= max_bytes else df


COARSER = 8       # from one level to the next
LEVELS = 10
SHARES = 16       # of a day without a key
TASKS_PER_CORE = 4


def _bucket_number(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / (seconds * 1_000_000)).cast("bigint")


def _coarse(bucket: Column, level: Column) -> Column:
    return F.floor(bucket / F.pow(F.lit(COARSER), level)).cast("bigint")


def filed_intervals(intervals: DataFrame, start_col: str, end_col: str, seconds: int) -> DataFrame:
    """Intervals under their coarse buckets (``__level``, ``__coarse``), two
    rows each at most; reversed ones contain nothing and go."""
    first, last = _bucket_number(F.col(start_col), seconds), _bucket_number(F.col(end_col), seconds)
    level = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        level = F.when(F.col("__last") - F.col("__first") < COARSER ** k, k).otherwise(level)
    return (intervals.where(F.col(start_col) <= F.col(end_col))
            .withColumn("__first", first).withColumn("__last", last).withColumn("__level", level)
            .withColumn("__coarse", F.explode(F.sequence(_coarse(F.col("__first"), F.col("__level")),
                                                         _coarse(F.col("__last"), F.col("__level"))))))


def intervals_by_bucket(buckets: DataFrame, intervals: DataFrame, start_col: str, end_col: str,
                        keys: Sequence[str], seconds: int) -> DataFrame:
    """Touched buckets (keys, ``__bucket``) with the intervals that reach in."""
    filed = filed_intervals(intervals, start_col, end_col, seconds)
    used = sorted(r[0] for r in filed.select("__level").distinct().collect())   # at most LEVELS + 1 numbers
    look = buckets.withColumn("__level", F.explode(F.array(*[F.lit(k) for k in used]) if used else F.array().cast("array<int>")))
    look = look.withColumn("__coarse", _coarse(F.col("__bucket"), F.col("__level")))
    both = look.join(filed, [*keys, "__level", "__coarse"])
    return both.where((F.col("__first") <= F.col("__bucket")) & (F.col("__bucket") <= F.col("__last"))).drop(
        "__first", "__last", "__level", "__coarse")


def interval_join(
    events: DataFrame,
    intervals: DataFrame,
    ts_col: str,
    start_col: str = "start_at",
    end_col: str = "end_at",
    keys: Sequence[str] = (),
    how: str = "left",
    bucket_seconds: int = 86_400,
    times: DataFrame | None = None,
    where: Column | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Join events to every interval that contains the event's timestamp.

    ``keys`` are equality columns present on both sides (e.g. the user name);
    the output keeps the event side's copy.  ``how`` is ``left`` or
    ``inner``.  Null timestamps and null keys match nothing.  ``times`` has
    the keys and ``ts_col`` of all events (more do no harm), if there is a
    cheaper source of them than ``events``.  ``where`` is a condition on the
    joined rows.  ``order``: event columns by which the result is sorted.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    number = _bucket_number(F.col(ts_col), bucket_seconds)
    touched = (events if times is None else times).select(*keys, number.alias("__bucket"))
    touched = touched.where(F.col("__bucket").isNotNull()).distinct()
    near = intervals_by_bucket(touched, intervals, start_col, end_col, list(keys), bucket_seconds)
    renamed = {k: f"__r_{k}" for k in [*keys, "__bucket"]}
    near = near.withColumnsRenamed(renamed)
    left = events.withColumn("__at", number)
    cond = [F.col("__at") == F.col("__r___bucket"), *[F.col(k) == F.col(renamed[k]) for k in keys],
            F.col(ts_col) >= F.col(start_col), F.col(ts_col) <= F.col(end_col)]
    if not keys:
        left, near, cond = _dealt_evenly(left, near, cond, order)
    joined = left.join(near, cond, how).drop("__at", "__share", "__r_share", *renamed.values())
    joined = joined if where is None else joined.where(where)
    return joined.orderBy(*order) if order else joined      # costs nothing where the events' order was kept


def _dealt_evenly(events: DataFrame, near: DataFrame, cond: list[Column], order: Sequence[str]) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Events, the intervals of their buckets and the condition, for a join
    whose work is spread over tasks whatever the number of buckets."""
    spark = events.sparkSession
    near = stored(near, scratch_dir(spark, "near-intervals"))      # counted, then read again
    small = sized_broadcast(near)
    if small is near:
        share = F.pmod(F.xxhash64(*events.columns), F.lit(SHARES))
        near = near.withColumn("__r_share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SHARES - 1).cast("bigint"))))
        return events.withColumn("__share", share), near, [*cond, F.col("__share") == F.col("__r_share")]
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    if not order:
        return events.repartition(tasks), small, cond
    # the condition is always true; without it the optimizer takes the sort below a join for useless
    kept = F.monotonically_increasing_id() >= 0
    return events.repartitionByRange(tasks, *order).sortWithinPartitions(*order).where(kept), small, cond


def interval_links(events: DataFrame, intervals: DataFrame, ts_col: str, tie: Sequence[str],
                   start_col: str = "start_at", end_col: str = "end_at") -> tuple[DataFrame, DataFrame]:
    """Events with ``segment`` and ``n_links``, and intervals with
    ``first_segment`` and ``last_segment``.

    ``tie``: columns that tell apart events of one time.  Segment 0 lies
    before the first interval; events without a time come back with nulls.
    Reversed intervals cover nothing and have null segments."""
    from histlake.operators.segments import SEGMENT, running_totals, segmented
    begin, end = F.unix_micros(F.col(start_col)), F.unix_micros(F.col(end_col)) + 1
    ahead = intervals.where(F.col(start_col) <= F.col(end_col))
    cuts = ahead.select(F.explode(F.array(F.struct(begin.alias("t"), F.lit(1).alias("d")),
                                          F.struct(end.alias("t"), F.lit(-1).alias("d")))).alias("c"))
    cuts = cuts.groupBy("c.t").agg(F.sum("c.d").alias("__opens"))
    columns = events.columns
    # a cut goes before the events of its time: the start belongs to the interval
    lines = events.select(F.unix_micros(F.col(ts_col)).alias("__t"), F.lit(1).alias("__kind"), *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)],
                          F.lit(0).cast("bigint").alias("__opens"), F.lit(0).alias("__cut"), F.struct(*columns).alias("__event"))
    cuts = cuts.select(F.col("t").alias("__t"), F.lit(0).alias("__kind"), *[F.lit(None).cast(lines.schema[f"__tie{i}"].dataType).alias(f"__tie{i}") for i in range(len(tie))],
                       "__opens", F.lit(1).alias("__cut"), F.lit(None).cast(lines.schema["__event"].dataType).alias("__event"))
    order = ["__t", "__kind", *[f"__tie{i}" for i in range(len(tie))]]
    seg = segmented(lines.unionByName(cuts), order)
    at = running_totals(seg, order, {"n_links": "__opens", "segment": "__cut"}).drop(SEGMENT)
    timed = F.col("__t").isNotNull()
    found = at.where(F.col("__kind") == 1).select(
        "__event.*", F.when(timed, F.col("segment")).alias("segment"), F.when(timed, F.col("n_links")).alias("n_links"))
    ends = at.where(F.col("__kind") == 0).select(F.col("__t"), F.col("segment").alias("__s"))
    covered = (intervals.withColumn("__b", F.when(F.col(start_col) <= F.col(end_col), begin))
               .withColumn("__e", F.when(F.col(start_col) <= F.col(end_col), end)))
    covered = covered.join(ends.withColumnsRenamed({"__t": "__b", "__s": "first_segment"}), "__b", "left")
    covered = covered.join(ends.select(F.col("__t").alias("__e"), (F.col("__s") - 1).alias("last_segment")), "__e", "left")
    return found, covered.drop("__b", "__e")


def overlapping_intervals(intervals: DataFrame, keys: Sequence[str], start_col: str = "start_at",
                          end_col: str = "end_at") -> DataFrame:
    """Intervals that begin before an earlier one of their key has ended, with
    the latest end before them (``covered_until``).

    A quality check: an interval overlaps some earlier one exactly if it
    starts at or before the latest earlier end, so no pairs are formed.
    Reversed intervals take no part; equal ones overlap each other."""
    order = [start_col, end_col, *[c for c in intervals.columns if c not in (*keys, start_col, end_col)]]
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = intervals.where(F.col(start_col) <= F.col(end_col))
    return ahead.withColumn("covered_until", F.max(end_col).over(earlier)).where(F.col(start_col) <= F.col("covered_until"))
