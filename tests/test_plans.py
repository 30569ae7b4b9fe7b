"""Physical-plan shape: the properties the operators rely on at scale."""

import datetime as dt

from pyspark.sql import functions as F

from histlake.operators import dedup, joins
from histlake.plans.catalog import Tables
from histlake.session import configure, scratch_dir
from histlake.sources import bindings as B
from histlake.sources import weather as WS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_before_the_shuffle(spark):
    from histlake.plans.pipelines import silver_streams
    configure(spark)
    p = plan(silver_streams(B.raw_plays(B.read_table(spark, SF, "events"))))  # fresh, unexecuted
    assert p.count("Exchange hashpartitioning(stream_id") == 1
    partial = p.index("WindowGroupLimit", p.index("Exchange hashpartitioning(stream_id"))
    assert "Partial" in p[partial:partial + 2000]


def test_key_count_is_aggregate_plus_join_not_window(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    p = plan(dedup.with_key_count(df, ["k"], "n"))
    assert "Window" not in p and "HashAggregate" in p


def test_interval_join_is_an_equi_join(spark):
    configure(spark)
    t = Tables(spark, SF)
    for keys in ([], ["username"]):
        locs = B.user_locations(t.events)
        if not keys:
            locs = locs.withColumnRenamed("username", "location_username")
        p = plan(joins.interval_join(t.silver(), locs, "streamed_at", keys=keys))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
        assert "SortMergeJoin" in p or "BroadcastHashJoin" in p or "ShuffledHashJoin" in p


def test_scans_read_only_needed_columns(spark):
    t = Tables(spark, SF)
    p = plan(B.customer_locations(t.orders, t.customer))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in p


def test_store_lookup_prunes_partitions(spark):
    configure(spark)
    utc = dt.timezone.utc
    rows = [(dt.datetime(2024, 1, d, tzinfo=utc), 1.0, "a", "b", 2.0, 3.0, 2024, 41.3, 2.083) for d in (1, 2)]
    rows += [(dt.datetime(2023, 1, 1, tzinfo=utc), 1.0, "a", "b", 2.0, 3.0, 2023, 41.3, 2.083)]
    from histlake.schemas import WEATHER_DAILY_SCHEMA
    root = scratch_dir(spark, "test-store")
    WS.write_store(spark.createDataFrame(rows, WEATHER_DAILY_SCHEMA), root, WS.DAILY)
    found = WS.lookup(spark, root, WS.DAILY, 2024, 41.3, 2.0834)
    p = plan(found)
    assert "PartitionFilters: [" in p and "(year" in p
    assert found.count() == 2


def test_quantiles_read_the_rows_twice_and_shuffle_what_is_near(spark):
    from histlake.operators import quantiles as Q
    path = scratch_dir(spark, "test-quantiles")
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    first = Q._first_pass(df, "v", Q.QUARTILES, ["k"], [F.max("v").alias("top")])
    p = plan(first)
    assert p.count("FileScan parquet") == 1 and p.count("Exchange hashpartitioning") == 1 and "partial_percentile_approx" in p
    second = Q._second_pass(df, "v", Q._targets(first, Q.QUARTILES, ["k"], 0), ["k"])
    p = plan(second)
    # the limits come as a broadcast, and a row above the upper limit ends before the aggregate
    assert "BroadcastHashJoin" in p and "rangepartitioning" not in p
    assert p.index("partial_count") < p.index("__high") and "Window" not in p


def test_interval_links_have_no_join_of_plays(spark):
    configure(spark)
    t = Tables(spark, SF)
    plays, _ = joins.interval_links(t.silver(), B.user_locations(t.events), "streamed_at", ["stream_id"])
    p = plan(plays)
    assert "NestedLoopJoin" not in p and "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert plays.count() == t.silver().count()


def test_counts_of_casts_take_no_pass_of_their_own(spark):
    from histlake.functions.casts import counted_casts
    configure(spark)
    typed, _ = counted_casts(B.raw_plays(B.read_table(spark, SF, "events")))
    p = plan(typed)
    assert p.count("FileScan parquet") == 1 and "CollectMetrics" in p and "Exchange" not in p
