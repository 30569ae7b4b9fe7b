"""Typing of bronze text into silver types.

Policies (both tested):

* flags, ``strict`` (default): ``try_cast(x as boolean)``; 'None' / '' / junk
  become null.  ``compat``: any non-empty text is True, which is what a plain
  string-to-bool conversion of the exported text yields.
* ``offline_timestamp``: text -> double -> NaN to null -> round half-even ->
  bigint.  Text that does not parse becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from histlake.schemas import BRONZE_SCHEMA, FLAG_COLUMNS, INT_COLUMNS

# Text forms treated as "missing" next to a real null.
MISSING_TOKENS = ["", "None", "nan"]


def is_missing(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | c.isin(*MISSING_TOKENS)


def parse_flag(col: Column | str, compat: bool = False) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if compat:
        return c.isNotNull() & (c != F.lit(""))
    return c.try_cast("boolean")


def clean_offline_timestamp(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    as_double = F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))
    return F.bround(as_double, 0).try_cast("bigint")


def parse_play_ts(col: Column | str) -> Column:
    """Export timestamps are ISO-8601 UTC text such as 2024-01-02T03:04:05Z."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp")


def _cast(name: str, compat_booleans: bool) -> Column:
    if name == "ts":
        return parse_play_ts("ts")
    if name == "ms_played":
        return F.col(name).try_cast("bigint")
    if name == "offline_timestamp":
        return clean_offline_timestamp(name)
    if name in FLAG_COLUMNS:
        return parse_flag(name, compat_booleans)
    if name == "snapshot_date":
        return F.col(name).cast("string").try_cast("timestamp")
    return F.col(name).cast("string")


def typed_plays(bronze: DataFrame, compat_booleans: bool = False) -> DataFrame:
    """Bronze (all text) -> typed plays, one ``select`` of casts.

    Keeps ``ts`` under its export name (renamed to ``streamed_at`` in silver)
    and turns the text ``snapshot_date`` into a UTC timestamp.  Text that
    does not cast becomes null; :func:`counted_casts` counts it.
    """
    return bronze.select(*[_cast(c, compat_booleans).alias(c) for c in BRONZE_SCHEMA.fieldNames()])


#: Columns whose cast can fail.
CAST_COLUMNS = ["ts", *INT_COLUMNS, *FLAG_COLUMNS, "snapshot_date"]


def _failed(name: str) -> Column:
    """A text that is there, stands for no missing value and does not cast."""
    return ~is_missing(name) & _cast(name, False).isNull()


def counted_casts(bronze: DataFrame, compat_booleans: bool = False) -> tuple[DataFrame, Observation]:
    """Typed plays, and counts taken in the same pass: per column of
    ``CAST_COLUMNS`` ``<column>.missing`` and ``<column>.failed``, and
    ``rows``.  They are there once the plays have been used by an action."""
    counts = Observation()
    each = [m for c in CAST_COLUMNS for m in (F.count_if(is_missing(c)).alias(f"{c}.missing"),
                                              F.count_if(_failed(c)).alias(f"{c}.failed"))]
    return typed_plays(bronze.observe(counts, F.count(F.lit(1)).alias("rows"), *each), compat_booleans), counts


def cast_rejects(bronze: DataFrame) -> DataFrame:
    """One row per field that does not cast: the play's user, time and
    snapshot as exported, the column and its text."""
    one = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("text"), _failed(c).alias("bad")) for c in CAST_COLUMNS])
    bad = F.filter(one, lambda f: f["bad"])
    return (bronze.select("username", F.col("ts").alias("exported_ts"), F.col("snapshot_date").alias("exported_snapshot"),
                          F.explode(bad).alias("f"))
            .select("username", "exported_ts", "exported_snapshot", "f.column_name", "f.text"))
