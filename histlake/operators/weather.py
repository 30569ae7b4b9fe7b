"""Set-based weather bookkeeping: which (year, coordinate) requests still
need a reply, over which dates, and how complete the store is.

All of these work on keys (a few rows per coordinate and year), with
partial aggregation before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.schemas import WEATHER_PARTITION_COLUMNS
from histlake.sources.weather import DAILY

KEYS = WEATHER_PARTITION_COLUMNS


def request_keys(year_coordinates: DataFrame) -> DataFrame:
    """(year, latitude, longitude) rounded to 3 decimals, like the request."""
    return year_coordinates.select(
        F.col("year").cast("int").alias("year"),
        *[c for c in year_coordinates.columns if c not in ("year", "latitude", "longitude")],
        F.round("latitude", 3).alias("latitude"), F.round("longitude", 3).alias("longitude"))


def request_window(requests: DataFrame, as_of: str) -> DataFrame:
    """Drop future years; the fetch runs from Jan 1 to min(Dec 31, as_of).
    ``as_of`` is a parameter (a date text), never the wall clock."""
    as_of_date = F.to_date(F.lit(as_of))
    return (requests.where(F.col("year") <= F.year(as_of_date))
            .withColumn("start_date", F.make_date(F.col("year"), F.lit(1), F.lit(1)))
            .withColumn("end_date", F.least(F.make_date(F.col("year"), F.lit(12), F.lit(31)), as_of_date)))


def _expected_rows(frequency: Column, year: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days = F.when(leap, 366).otherwise(365)
    return F.when(frequency == DAILY, days).otherwise(days * 24)


def completeness(store_rows: DataFrame) -> DataFrame:
    """Rows per (frequency, year, latitude, longitude) against the calendar:
    365/366 daily rows, 8,760/8,784 hourly rows."""
    counts = store_rows.groupBy("frequency", *KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    expected = _expected_rows(F.col("frequency"), F.col("year"))
    return (counts.withColumn("expected_rows", expected.cast("int"))
                  .withColumn("complete", F.col("n_rows") >= F.col("expected_rows")))


def present_keys(daily: DataFrame, hourly: DataFrame, mode: str = "exists") -> DataFrame:
    """Keys already in the store for *both* frequencies.

    ``exists``: any row at all (a partly fetched current year counts as
    present); ``complete``: the full calendar of rows in both.
    """
    if mode == "exists":
        d = daily.select(*KEYS).distinct()
        h = hourly.select(*KEYS).distinct()
    elif mode == "complete":
        d = completeness(daily).where("complete").select(*KEYS)
        h = completeness(hourly).where("complete").select(*KEYS)
    else:
        raise ValueError("mode must be 'exists' or 'complete'")
    return d.join(h, KEYS, "left_semi")


def missing_requests(requests: DataFrame, daily: DataFrame, hourly: DataFrame,
                     mode: str = "exists", force: bool = False) -> DataFrame:
    """Requests whose key is not yet present in both frequencies
    (``force`` re-requests everything)."""
    if force:
        return requests
    return requests.join(present_keys(daily, hourly, mode), KEYS, "left_anti")
