"""Round trips through the sinks: idempotent reruns, typed partition values."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql.utils import AnalysisException

from histlake.session import scratch_dir
from histlake.sources import sinks, weather


def _silver_row(user, ts):
    from histlake.schemas import SILVER_COLUMNS
    row = {c: None for c in SILVER_COLUMNS}
    row.update(stream_id=f"{user}-{ts:%s}", streamed_year=ts.year, streamed_at=ts, username=user,
               ms_played=5, offline_timestamp=7, shuffle=True)
    return tuple(row[c] for c in SILVER_COLUMNS)


def test_silver_rerun_is_idempotent_and_keeps_text_partitions(spark):
    from histlake.schemas import SILVER_SCHEMA
    utc = dt.timezone.utc
    rows = [_silver_row("007", dt.datetime(2023, 5, 1, tzinfo=utc)),
            _silver_row("007", dt.datetime(2024, 5, 1, tzinfo=utc)),
            _silver_row("alice", dt.datetime(2024, 6, 1, tzinfo=utc))]
    df = spark.createDataFrame(rows, SILVER_SCHEMA)
    path = scratch_dir(spark, "test-silver")
    sinks.write_silver(df, path)
    sinks.write_silver(df, path)
    back = sinks.read_silver(spark, path)
    assert back.count() == 3
    assert sorted({r.username for r in back.collect()}) == ["007", "alice"]
    # a rerun with only one partition replaces that partition and keeps others
    sinks.write_silver(df.where("username = 'alice'"), path)
    assert sinks.read_silver(spark, path).count() == 3


def test_weather_lookup_on_missing_store_is_empty(spark):
    root = tempfile.mkdtemp(prefix="histlake-none-") + "/absent"
    assert weather.lookup(spark, root, "daily", 2024, 41.3, 2.08).count() == 0


def test_manifest_plain_layout_keeps_json_only(spark):
    import datetime as dt
    import os
    from histlake.sources.landing import file_manifest
    root = tempfile.mkdtemp(prefix="histlake-drop-")
    os.makedirs(f"{root}/user-alpha")
    for name in ("a.json", "b.json", "notes.txt"):
        with open(f"{root}/user-alpha/{name}", "w") as f:
            f.write("[]")
    os.utime(f"{root}/user-alpha/a.json", (1733866211, 1733866211))  # 2024-12-10 21:30:11 UTC
    rows = {r.basename: r for r in file_manifest(spark, root, dt.datetime(2024, 12, 11)).collect()}
    assert set(rows) == {"a.json", "b.json"}
    assert rows["a.json"].username == "user-alpha"
    assert str(rows["a.json"].snapshot_date) == "2024-12-10"


def test_writes_keep_other_partitions_in_a_static_session(spark):
    import __spark_entry__ as e
    from histlake.session import scratch_dir
    from histlake.sources import sinks

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    silver = e.queries()["silver_streams"](spark, "/root/testdata/sf0.001")
    silver = silver.withColumn("streamed_at", silver.streamed_at.cast("timestamp"))
    users = [r.username for r in silver.select("username").distinct().orderBy("username").limit(2).collect()]
    path = scratch_dir(spark, "static")
    sinks.write_silver(silver.where(silver.username == users[0]), path)
    sinks.write_silver(silver.where(silver.username == users[1]), path)
    stored = sinks.read_silver(spark, path)
    assert stored.select("username").distinct().count() == 2
    before = stored.count()
    sinks.merge_silver(silver.where(silver.username.isin(users)).limit(3), path)
    assert sinks.read_silver(spark, path).count() == before


def test_reversed_bounds_give_the_first_year(spark):
    from histlake.operators.years import year_list

    df = spark.sql("SELECT timestamp'2023-05-01' AS start_at, timestamp'2021-05-01' AS end_at")
    assert [r.year for r in year_list(df).collect()] == [2023]


def test_external_table_keeps_text_partitions_and_is_replaced(spark, tmp_path):
    from pyspark.sql import types as T

    from histlake.sources.sinks import external_table
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("username", T.StringType())])
    for at, x in (("one", 1), ("two", 2)):
        path = str(tmp_path / at)
        spark.createDataFrame([(x, "007")], schema).write.partitionBy("username").parquet(path)
        external_table(spark, path, "histlake_ext_test", ("username",), schema)
        assert [tuple(r) for r in spark.table("histlake_ext_test").select("x", "username").collect()] == [(x, "007")]
    spark.sql("DROP TABLE histlake_ext_test")


def test_scratch_folders_can_be_released(spark, tmp_path, monkeypatch):
    from histlake import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    path = session.scratch_dir(spark, "test-release")
    assert session.stored(spark.range(3), path).count() == 3 and session.release(spark) == 1
    assert session.release(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()
