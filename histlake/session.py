"""Session settings the library relies on.

* Session time zone UTC: every timestamp in the data model is a UTC instant.
* AQE with skew-join splitting and partition coalescing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "histlake") -> SparkSession:
    """Session for tests and local runs.  On a cluster, use the cluster's
    session and call :func:`configure` on it instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("HISTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on to any session."""
    for key, value in RUNTIME_CONF.items():
        if key == "spark.sql.session.timeZone" or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return list_in_few_tasks(spark)


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_in_few_tasks(spark: SparkSession) -> SparkSession:
    """Let some tasks per core list folders and files, not one task for each
    folder or file (up to 10,000, and again in every micro-batch of a stream);
    a value that was set is left."""
    if spark.conf.get(LISTING_TASKS, None) is None:
        spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at shared storage.
    Only when it is unset and the master is local (tests) do we create one of
    our own; executors elsewhere would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="histlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root; see
    :func:`release`."""
    path = f"{checkpoint_root(spark)}/histlake-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the folders that :func:`scratch_dir` has given out so far and
    return their number.  Call it when the results that were computed from
    them are written: frames that still read them cannot be used after."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet and read back: cuts the lineage and
    keeps non-deterministic columns (partition numbers) fixed for readers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
