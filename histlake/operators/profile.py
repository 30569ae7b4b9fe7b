"""Column profiles: category frequencies, flag counts, missing counts,
numeric / timestamp / string summaries.

Many columns are profiled in one pass by unpivoting them into
``(column_name, value)`` pairs and aggregating; every aggregation is
partial (map-side) first.

Exact quantiles come from :mod:`histlake.operators.quantiles`: two passes over
the rows, the first of which also takes the other statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.functions.casts import is_missing
from histlake.operators.quantiles import exact_quantiles


def _pairs(df: DataFrame, columns: Sequence[str], value_type: str | None = None) -> DataFrame:
    cols = [F.col(c).cast(value_type).alias(c) if value_type else F.col(c) for c in columns]
    return df.select(*cols).unpivot([], list(columns), "column_name", "value")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, count) per non-null value, most frequent first."""
    p = _pairs(df, columns, "string").where(F.col("value").isNotNull())
    return (p.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
             .orderBy("column_name", F.desc("count"), "value"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, count) of same-typed columns (e.g. flags), nulls dropped."""
    p = _pairs(df, columns).where(F.col("value").isNotNull())
    return p.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, missing_count): null, '' , 'None' or 'nan' per column,
    all columns in one aggregation pass."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(is_missing(F.col(c).cast("string"))).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "missing_count")


def rounding_diff(df: DataFrame, column: str) -> DataFrame:
    """Sum of ``x - round_half_even(x)`` over parsable, non-NaN values."""
    x = F.nanvl(F.col(column).try_cast("double"), F.lit(None).cast("double"))
    return df.select(x.alias("x")).agg(
        F.sum(F.col("x") - F.bround("x", 0)).alias("rounding_diff_sum"),
        F.count("x").alias("n_values"))


def _wide(q: DataFrame, key: str) -> DataFrame:
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    return q.groupBy(key).agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                for p, n in names.items()])


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, 25 / 50 / 75 %, max per column."""
    p = _pairs(df, columns, "double").where(F.col("value").isNotNull())
    q, stats = exact_quantiles(p, "value", key="column_name", extra=[
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")])
    return stats.join(_wide(q, "column_name"), "column_name").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def timestamp_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, min, quartiles, max of timestamp columns, to the
    microsecond (mean and quartiles floored)."""
    p = (df.select(*[F.unix_micros(F.col(c)).alias(c) for c in columns])
           .unpivot([], list(columns), "column_name", "us").where(F.col("us").isNotNull()))
    q, stats = exact_quantiles(p, "us", key="column_name", extra=[
        F.count("us").alias("count"), F.sum(F.col("us").cast("decimal(38,0)")).alias("total"),
        F.min("us").alias("min_us"), F.max("us").alias("max_us")])
    mean = F.floor(F.col("total") / F.col("count")).cast("bigint")
    out = stats.join(_wide(q, "column_name"), "column_name")

    def ts(c: Column | str) -> Column:
        return F.timestamp_micros(F.col(c) if isinstance(c, str) else c)

    def floored(c: str) -> Column:
        return ts(F.floor(c).cast("bigint")).alias(c)

    return out.select("column_name", "count", ts(mean).alias("mean"), ts("min_us").alias("min"), floored("p25"), floored("p50"),
                      floored("p75"), ts("max_us").alias("max"))


def string_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per text column (top: most frequent value,
    the smallest such value on ties)."""
    p = _pairs(df, columns, "string").where(F.col("value").isNotNull())
    vc = p.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return vc.groupBy("column_name").agg(
        F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("cnt")).alias("k"), F.col("value").alias("v"))).alias("top"),
        F.max("cnt").alias("freq"))
