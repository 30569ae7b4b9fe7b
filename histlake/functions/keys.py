"""Surrogate key of a play: MD5 of the '-'-joined text forms of 20 columns.

Text forms follow the export tool's string conversion so keys stay stable
across re-implementations:

* timestamp -> ``yyyy-MM-dd HH:mm:ss+00:00`` (UTC offset), with ``.ffffff``
  after the seconds where they are not whole;
* nullable integer -> digits, missing -> ``<NA>``;
* flag -> ``True`` / ``False``, missing -> ``None``;
* text -> as is, missing -> ``None``.

Every part is coalesced *before* ``concat_ws`` because ``concat_ws`` drops
nulls, which would shift the remaining parts.  The join is ambiguous when a
value contains '-' ('a-b','c' vs 'a','b-c'); that is kept for key parity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.schemas import FLAG_COLUMNS, INT_COLUMNS, KEY_COLUMNS

# Text used for missing values inside the key string.
MISSING_INT_TEXT = "<NA>"
MISSING_TEXT = "None"
TS_KEY_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _part(name: str, ts_column: str) -> Column:
    if name == "ts":
        ts = F.col(ts_column)
        fraction = F.date_format(ts, ".SSSSSS")
        text = F.concat(F.date_format(ts, TS_KEY_FORMAT), F.when(fraction != ".000000", fraction).otherwise(""),
                        F.date_format(ts, "xxx"))
        return F.coalesce(text, F.lit("NaT"))
    if name in INT_COLUMNS:
        return F.coalesce(F.col(name).cast("string"), F.lit(MISSING_INT_TEXT))
    if name in FLAG_COLUMNS:
        return F.coalesce(F.initcap(F.col(name).cast("string")), F.lit(MISSING_TEXT))
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING_TEXT))


def key_text(ts_column: str = "ts") -> Column:
    return F.concat_ws("-", *[_part(c, ts_column) for c in KEY_COLUMNS])


def surrogate_key(df: DataFrame, ts_column: str = "ts", name: str = "stream_id") -> DataFrame:
    return df.withColumn(name, F.md5(key_text(ts_column)))
