"""Validity intervals -> years -> airport coordinates.

The year list between the global first and last year is a ``sequence`` +
``explode`` (no recursive query needed), and the range theta join
``year BETWEEN year(start) AND year(end)`` becomes a per-row explode of the
interval's own years: no join at all.  A reversed interval whose end year is
before its start year yields no years (``sequence`` would count down).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.operators.joins import sized_broadcast


def year_bounds(locations: DataFrame) -> DataFrame:
    return locations.agg(F.year(F.min("start_at")).cast("int").alias("min_year"),
                         F.year(F.max("end_at")).cast("int").alias("max_year"))


def year_list(locations: DataFrame) -> DataFrame:
    """Every year from the first start to the last end (one row per year);
    the first year alone if the last end lies before it."""
    b = year_bounds(locations)
    return b.select(F.explode(F.sequence("min_year", F.greatest("min_year", "max_year"))).alias("year"))


def user_years(locations: DataFrame) -> DataFrame:
    """(year, username, airport_code) for each year an interval touches."""
    y0 = F.year("start_at")
    y1 = F.year("end_at")
    return (locations.where(y0 <= y1)
            .select(F.explode(F.sequence(y0, y1)).alias("year"), "username", "airport_code")
            .select(F.col("year").cast("int").alias("year"), "username", "airport_code"))


def years_code(locations: DataFrame) -> DataFrame:
    """Distinct (year, airport_code): partial aggregation before the shuffle."""
    return user_years(locations).select("year", "airport_code").distinct()


def year_coordinates(locations: DataFrame, airports: DataFrame,
                     broadcast_max_rows: int = 1_000_000) -> DataFrame:
    """Distinct (year, airport) joined to the airport's coordinates, ordered
    by year and latitude.  Codes without an airport drop out (inner join)."""
    ap = sized_broadcast(airports.select("airport_code", "latitude", "longitude"), broadcast_max_rows)
    return (years_code(locations).join(ap, "airport_code")
            .select("year", "airport_code", "latitude", "longitude")
            .orderBy("year", "latitude"))
