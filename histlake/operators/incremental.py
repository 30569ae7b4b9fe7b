"""Incremental loading in batch form.

* :func:`watermark_load` - per user, keep only plays newer than the user's
  last loaded timestamp (1970-01-01 when the user is new), drop repeated
  (user, ts) plays, and return the rows together with the advanced
  watermarks.  The watermark table has one row per user: it is broadcast
  when its size is under the bound, otherwise joined by shuffle.
Where the watermarks and the ledger of files are kept between runs:
:mod:`histlake.sources.silver_table`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.operators.dedup import keep_first
from histlake.operators.joins import sized_broadcast

# Fixed value: watermark of a user that was never loaded.
EPOCH_START = "1970-01-01 00:00:00"


def watermark_load(batch: DataFrame, watermarks: DataFrame, ts_col: str = "ts",
                   broadcast_max_rows: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    wm = sized_broadcast(watermarks.select("username", F.col("max_ts").alias("__wm")), broadcast_max_rows)
    floor = F.coalesce(F.col("__wm"), F.lit(EPOCH_START).cast("timestamp"))
    fresh = batch.join(wm, "username", "left").where(F.col(ts_col) > floor).drop("__wm")
    rows = keep_first(fresh, ["username", ts_col], ["snapshot_date"] if "snapshot_date" in batch.columns else [])
    new_max = fresh.groupBy("username").agg(F.max(ts_col).alias("__new"))
    advanced = (watermarks.select("username", F.col("max_ts").alias("__old"))
                .join(new_max, "username", "full")
                .select("username", F.greatest("__old", "__new").alias("max_ts")))
    return rows, advanced
