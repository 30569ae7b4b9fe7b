"""CSV sources and sinks: airports, user locations, year coordinates.

Every reader takes an explicit schema (no inference pass over the data, and
no type guessing of codes such as '007').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.schemas import AIRPORTS_FILE_SCHEMA, USER_LOCATION_SCHEMA, YEAR_COORDINATES_SCHEMA

# The text form of timestamps with a UTC offset, as in
# ``2024-06-24 10:00:00+00:00``.
OFFSET_TS_FORMAT = "yyyy-MM-dd HH:mm:ssXXX"


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """';'-separated airports file with header ``Airport Code;Latitude;Longitude``."""
    df = (spark.read.schema(AIRPORTS_FILE_SCHEMA).option("header", True).option("sep", ";")
          .option("mode", "FAILFAST").csv(path))
    return df.withColumnsRenamed({"Airport Code": "airport_code", "Latitude": "latitude",
                                  "Longitude": "longitude"})


def write_airports(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)


def read_user_locations(spark: SparkSession, path: str) -> DataFrame:
    """``username,start_at,end_at,airport_code``; timestamps carry an offset
    and become UTC instants."""
    return (spark.read.schema(USER_LOCATION_SCHEMA).option("header", True)
            .option("timestampFormat", OFFSET_TS_FORMAT).option("mode", "FAILFAST").csv(path))


def write_user_locations(df: DataFrame, path: str) -> None:
    (df.select("username",
               F.date_format("start_at", "yyyy-MM-dd HH:mm:ssxxx").alias("start_at"),
               F.date_format("end_at", "yyyy-MM-dd HH:mm:ssxxx").alias("end_at"),
               "airport_code")
     .write.mode("overwrite").option("header", True).csv(path))


def write_year_coordinates(df: DataFrame, path: str) -> None:
    df.select("year", "airport_code", "latitude", "longitude").write.mode("overwrite") \
        .option("header", True).csv(path)


def read_year_coordinates(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(YEAR_COORDINATES_SCHEMA).option("header", True)
            .option("mode", "FAILFAST").csv(path))
