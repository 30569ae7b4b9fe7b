"""Duplicate analysis and removal, written to survive hot keys.

Assume one key may hold a third of all rows.  Nothing here sends all rows of
one key to one task:

* ``keep_first``: ``row_number() = 1`` over (key, full order).  Spark plans a
  *partial* WindowGroupLimit before the shuffle, so every map task already
  reduces a key to one row.
* ``with_key_count`` / ``duplicate_rows``: partial aggregate of counts per key
  (map-side combine), then a join back; AQE splits a hot key on the row side.
* ``numbered_rows``: exact row numbers inside a key without a window over the
  raw rows: identical rows are first collapsed into runs (partial aggregate),
  the window runs over the runs of a key (bounded by the number of distinct
  row versions, e.g. snapshots), and runs are expanded again in chunks that
  are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.operators.joins import sized_broadcast

EXPAND_CHUNK = 10_000


def _order(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> list[Column]:
    """Requested order, then every remaining column, for a total order."""
    named = {o for o in order if isinstance(o, str)}
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    cols += [F.col(c) for c in df.columns if c not in named and c not in keys]
    return cols


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the first by ``order`` (remaining columns break ties,
    so the survivor is deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _join_counts(df: DataFrame, counts: DataFrame, keys: Sequence[str],
                 broadcast_max_rows: int | None) -> DataFrame:
    if broadcast_max_rows is not None:
        counts = sized_broadcast(counts, broadcast_max_rows)
    # null keys never match in an equi-join: use null-safe equality
    cond = [df[k].eqNullSafe(counts[k]) for k in keys]
    out = df.join(counts, cond, "inner")
    for k in keys:
        out = out.drop(counts[k])
    return out


def with_key_count(df: DataFrame, keys: Sequence[str], name: str = "count",
                   broadcast_max_rows: int | None = None) -> DataFrame:
    """Every row with the number of rows sharing its key (``count() over
    (partition by key)`` without a window over a possibly hot key)."""
    return _join_counts(df, key_counts(df, keys, name), keys, broadcast_max_rows)


def duplicate_rows(df: DataFrame, keys: Sequence[str], name: str = "count",
                   broadcast_max_rows: int | None = None) -> DataFrame:
    """All rows whose key occurs more than once, with the key's count."""
    dups = key_counts(df, keys, name).where(F.col(name) > 1)
    return _join_counts(df, dups, keys, broadcast_max_rows)


def numbered_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
                  rn_name: str = "rn", count_name: str = "count", min_rn: int = 1,
                  only_duplicated: bool = False, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Rows with ``row_number`` and ``count`` over (partition by keys order by
    order, then all other columns); keeps rows with ``rn >= min_rn``.

    Identical rows are interchangeable, so they are numbered as one run.
    """
    cols = df.columns
    runs = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, order))
    runs = (runs
            .withColumn("__end", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("__cnt", F.sum("__n").over(Window.partitionBy(*keys))))
    if only_duplicated:
        runs = runs.where(F.col("__cnt") > 1)
    runs = runs.withColumn("__lo", F.greatest(F.col("__end") - F.col("__n") + 1, F.lit(min_rn)))
    runs = runs.where(F.col("__lo") <= F.col("__end"))
    # spread long runs: explode chunk descriptors, redistribute, then expand
    chunks = runs.withColumn(
        "__c", F.explode(F.sequence(F.lit(0), F.floor((F.col("__end") - F.col("__lo")) / chunk))))
    chunks = chunks.repartition(*[F.col(k) for k in keys], F.col("__c"))
    lo = F.col("__lo") + F.col("__c") * chunk
    hi = F.least(lo + chunk - 1, F.col("__end"))
    out = chunks.withColumn("__rn", F.explode(F.sequence(lo, hi)))
    return out.select(*cols, F.col("__rn").cast("int").alias(rn_name),
                      F.col("__cnt").cast("bigint").alias(count_name))
