"""Weather documents (JSON) and the partitioned weather store (Parquet).

A document is one reply for one (year, latitude, longitude): the ``daily``
and ``hourly`` blocks are structs of parallel arrays.  Flattening zips the
arrays of a block and turns each position into a row (``inline`` of
``arrays_zip``), all inside the JVM.  Documents are read one per JSON line;
pretty-printed single-document files need ``multi_line=True`` (one task per
file, since such files are not splittable).

The store keeps two layouts under one root: ``frequency=daily`` and
``frequency=hourly``, each partitioned by year, latitude, longitude.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from histlake.schemas import (
    WEATHER_DAILY_SCHEMA,
    WEATHER_DOC_SCHEMA,
    WEATHER_HOURLY_SCHEMA,
    WEATHER_PARTITION_COLUMNS,
)

DAILY = "daily"
HOURLY = "hourly"
FREQUENCIES = (DAILY, HOURLY)
# Time formats of the two blocks.
DAILY_TIME_FORMAT = "yyyy-MM-dd"
HOURLY_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def write_documents(docs: DataFrame, path: str) -> None:
    docs.select(F.to_json(F.struct(*docs.columns)).alias("value")).write.mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(WEATHER_DOC_SCHEMA).option("multiLine", multi_line).json(path)


def _stamp(df: DataFrame) -> DataFrame:
    """Request coordinates, rounded to 3 decimals, stamped on every row."""
    return (df.withColumn("year", F.col("year").cast("int"))
              .withColumn("latitude", F.round("latitude", 3))
              .withColumn("longitude", F.round("longitude", 3)))


def flatten_daily(docs: DataFrame) -> DataFrame:
    cols = ["time", "weather_code", "sunrise", "sunset", "daylight_duration", "sunshine_duration"]
    z = F.arrays_zip(*[F.col(f"daily.{c}").alias(c) for c in cols])
    rows = docs.where(F.col("daily").isNotNull()).select(
        "year", "latitude", "longitude", F.inline(z))
    rows = rows.withColumn("date", F.to_timestamp("time", DAILY_TIME_FORMAT))
    rows = _stamp(rows).withColumn("frequency", F.lit(DAILY))
    return rows.select(*WEATHER_DAILY_SCHEMA.fieldNames(), "frequency")


def flatten_hourly(docs: DataFrame) -> DataFrame:
    cols = ["time", "temperature_2m", "cloud_cover"]
    z = F.arrays_zip(*[F.col(f"hourly.{c}").alias(c) for c in cols])
    rows = docs.where(F.col("hourly").isNotNull()).select(
        "year", "latitude", "longitude", F.inline(z))
    rows = rows.withColumn("datetime", F.to_timestamp("time", HOURLY_TIME_FORMAT))
    rows = _stamp(rows).withColumn("frequency", F.lit(HOURLY))
    return rows.select(*WEATHER_HOURLY_SCHEMA.fieldNames(), "frequency")


def _schema(frequency: str):
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {FREQUENCIES}, got {frequency!r}")
    return WEATHER_DAILY_SCHEMA if frequency == DAILY else WEATHER_HOURLY_SCHEMA


def write_store(rows: DataFrame, root: str, frequency: str) -> None:
    """Write one frequency under ``root/frequency=<f>``, partitioned by year,
    latitude, longitude.  Rows are clustered by partition first so each
    partition folder gets one file; dynamic overwrite replaces only the
    partitions present in ``rows`` (a re-fetch of a year replaces it)."""
    schema = _schema(frequency)
    (rows.select(*schema.fieldNames())
         .repartition(*WEATHER_PARTITION_COLUMNS)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*WEATHER_PARTITION_COLUMNS)
         .parquet(f"{root.rstrip('/')}/frequency={frequency}"))


def read_store(spark: SparkSession, root: str, frequency: str) -> DataFrame:
    """One frequency subtree with typed partition columns; an absent store
    gives an empty frame with the fixed schema."""
    schema = _schema(frequency)
    base = f"{root.rstrip('/')}/frequency={frequency}"
    try:
        df = spark.read.schema(schema).option("basePath", base).parquet(base)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    return df.withColumn("frequency", F.lit(frequency))


def lookup(spark: SparkSession, root: str, frequency: str, year: int,
           latitude: float, longitude: float) -> DataFrame:
    """Rows of one (frequency, year, latitude, longitude) partition, found by
    partition pruning; no rows when the partition does not exist."""
    df = read_store(spark, root, frequency)
    return df.where((F.col("year") == year)
                    & (F.col("latitude") == F.round(F.lit(float(latitude)), 3))
                    & (F.col("longitude") == F.round(F.lit(float(longitude)), 3)))
