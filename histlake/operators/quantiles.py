"""Exact quantiles by refinement of ranks, in two passes over the rows.

A quantile with linear interpolation needs the values at one or two ranks.
Sorting all values for them is wasteful, and an exact ``percentile`` holds a
whole column in one buffer.  Instead:

1. one pass takes the count and, per wanted quantile, two sketch quantiles
   around it; the sketch's guaranteed rank error of 1 / ``ACCURACY`` makes
   them a lower and an upper limit of the wanted values;
2. a second pass collapses the values between the limits to (value, count),
   about 4 / ``ACCURACY`` of the rows per quantile, and only counts the rows
   below the lower limit; nothing above the upper limit is kept.

Only aggregates with a map-side part shuffle.  The ranks inside what was
kept come from a running total, over segments if there are many values.
Groups of at most ``FEW`` rows need no limits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.operators.joins import sized_broadcast
from histlake.operators.segments import running_totals, segmented
from histlake.session import scratch_dir, stored

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000
FEW = 200_000


def _first_pass(df: DataFrame, value: str, probs: Sequence[float], keys: list[str], extra: Sequence[Column]) -> DataFrame:
    near = [min(1.0, max(0.0, p + d)) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY)]
    return df.groupBy(*keys).agg(
        F.count(value).alias("__n"), F.percentile_approx(F.col(value).cast("double"), near, ACCURACY).alias("__near"), *extra)


def _targets(first: DataFrame, probs: Sequence[float], keys: list[str], few: int) -> DataFrame:
    """One row per key and quantile: ranks ``__lo`` and ``__hi`` (from 0) and
    the limits of their values."""
    each = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col("__near")[2 * i].alias("low"),
                                        F.col("__near")[2 * i + 1].alias("high")) for i, p in enumerate(probs)]))
    t = first.select(*keys, "__n", each.alias("t")).select(*keys, "__n", "t.*")
    pos = F.col("prob") * (F.col("__n") - 1)
    many = F.col("__n") > few
    return t.select(*keys, "prob", pos.alias("__pos"), F.floor(pos).alias("__lo"), F.ceil(pos).alias("__hi"),
                    F.when(many, F.col("low")).otherwise(float("-inf")).alias("__low"),
                    F.when(many, F.col("high")).otherwise(float("inf")).alias("__high"))


def _second_pass(df: DataFrame, value: str, targets: DataFrame, keys: list[str]) -> DataFrame:
    """(key, prob, __v, __c): values between the limits; null: all below."""
    x = F.col(value).cast("double")
    near = df.join(sized_broadcast(targets), keys).where(x <= F.col("__high"))
    return near.groupBy(*keys, "prob", F.when(x >= F.col("__low"), F.col(value)).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))


def _ranked(freq: DataFrame, keys: list[str], few: int) -> DataFrame:
    """Adds ``__end``: how many rows of the group are at or before this value."""
    group = [*keys, "prob"]
    if freq.count() <= few:
        w = Window.partitionBy(*group).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return freq.withColumn("__end", F.sum("__c").over(w))
    seg = segmented(freq, [*group, "__v"])
    total = running_totals(seg, [*group, "__v"], {"__total": "__c"})
    # one row per key and quantile
    sums = freq.groupBy(*group).agg(F.sum("__c").alias("__s"))
    before = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    return total.join(sized_broadcast(sums), group).withColumn("__end", F.col("__total") - F.col("__base"))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float] = QUARTILES, key: str | None = None,
                    extra: Sequence[Column] = (), few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """Quantiles of numeric ``value`` per ``key`` (a column with few values,
    such as a column name) or of all rows, linearly interpolated.

    Returns the quantiles (key, prob, quantile) and one row per key with the
    ``extra`` aggregates, taken in the first pass.  Null and NaN values take
    no part; null keys neither."""
    spark = df.sparkSession
    keys = [key or "__all"]
    v = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    v = v if key else v.withColumn("__all", F.lit(0))
    first = stored(_first_pass(v, value, probs, keys, extra), scratch_dir(spark, "quantile-limits"))
    targets = _targets(first, probs, keys, few)
    freq = stored(_second_pass(v, value, targets, keys), scratch_dir(spark, "quantile-values"))
    group = [*keys, "prob"]
    ranked = _ranked(freq, keys, few).join(sized_broadcast(targets), group)

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("__end") - F.col("__c") <= F.col(rank)) & (F.col(rank) < F.col("__end")),
                            F.col("__v").cast("double")))

    found = ranked.groupBy(*group, "__pos", "__lo").agg(at("__lo").alias("a"), at("__hi").alias("b"))
    q = F.col("a") + (F.col("b") - F.col("a")) * (F.col("__pos") - F.col("__lo"))
    return found.select(*group, q.alias("quantile")).drop("__all"), first.drop("__n", "__near", "__all")
