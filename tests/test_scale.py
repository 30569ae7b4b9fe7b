"""Layouts whose files do not grow in number with the users; whole results."""

import os

import pytest
from pyspark.sql import functions as F

from histlake.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from histlake.session import scratch_dir
from histlake.sources import bindings as B
from histlake.sources import sinks
from histlake.sources.landing import read_landing, write_landing

SF = "/root/testdata/sf0.001"


def files_below(root):
    return [f for _, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))]


def bronze(spark, users, more="x"):
    rows = spark.range(users).select(F.concat(F.lit("u"), "id").alias("username"), F.lit("2024-01-01").alias("snapshot_date"), F.lit(more).alias("ts"))
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in BRONZE_SCHEMA.fieldNames()])


def test_users_share_folders_and_keep_their_partitions(spark):
    path = scratch_dir(spark, "test-shared")
    sinks.write_bronze(bronze(spark, 400).withColumn("file_name", F.lit("a.json")), path)
    assert len(files_below(path)) <= sinks.USER_BUCKETS
    # one user's partition is replaced, with nulls in a column it has not; the others stay as they were
    sinks.write_bronze(bronze(spark, 1, "y"), path)
    sinks.write_bronze(bronze(spark, 1, "z").withColumn("username", F.lit(None).cast("string")), path)
    back = {r.username: (r.ts, r.file_name) for r in sinks.read_bronze(spark, path, ("file_name",)).collect()}
    assert len(back) == 401 and back.pop("u0") == ("y", None) and back.pop(None) == ("z", None)
    assert set(back.values()) == {("x", "a.json")}
    mine = sinks.of_user(sinks.read_bronze(spark, path), "u7")
    assert mine.count() == 1
    filters = mine._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert sinks.BUCKET in filters


def test_merged_users_share_folders(spark):
    path = scratch_dir(spark, "test-shared-silver")
    base = {f.name: F.lit(None).cast(f.dataType) for f in SILVER_SCHEMA}
    rows = spark.range(400).select(*[c.alias(n) for n, c in (base | {
        "stream_id": F.col("id").cast("string"), "username": F.concat(F.lit("u"), F.col("id").cast("string")), "streamed_year": F.lit(2024)}).items()])
    sinks.merge_silver(rows.where("stream_id < '3'"), path)
    sinks.merge_silver(rows, path)
    assert sinks.read_silver(spark, path).count() == 400 and len(files_below(path)) <= 2 * sinks.USER_BUCKETS
    # the key is that of the partition: another user's play of this id is a play of its own
    sinks.merge_silver(rows.where("stream_id = '1'").withColumn("username", F.lit("other")), path)
    assert sinks.read_silver(spark, path).where("stream_id = '1'").count() == 2


def test_line_documents_share_files(spark):
    root = scratch_dir(spark, "test-shared-lines")
    docs = spark.range(0, 300, 1, 2).select(F.format_string('[{"ts": "%d"}]', "id").alias("body"), F.concat(F.lit("u"), "id").alias("username"),
                                            F.lit("2024-01-01").alias("snapshot_date"), F.lit("a.json").alias("file_name"))
    write_landing(docs, root)
    assert len(files_below(root)) <= 2
    assert {(r.ts, r.username, r.file_name) for r in read_landing(spark, root, "lines").plays.collect()} == {(str(i), f"u{i}", "a.json") for i in range(300)}


def test_interval_join_gives_one_row_per_pair(spark):
    from histlake.operators.joins import interval_links
    from histlake.plans.catalog import QUERIES, Tables
    t = Tables(spark, SF)
    links = interval_links(t.silver(), B.user_locations(t.events), "streamed_at", ["stream_id"])[0]
    pairs = QUERIES["location_interval_join"](spark, SF)
    assert {"start_at", "end_at", "airport_code", "location_username"} <= set(pairs.columns)
    assert pairs.count() == links.agg(F.sum(F.greatest("n_links", F.lit(1)))).first()[0]
    found = QUERIES["location_interval_filtered"](spark, SF)
    assert found.columns == pairs.columns and found.count() == pairs.where("airport_code = 'AP03'").count() > 0


def test_documents_are_split_by_the_size_of_their_group(spark):
    rows = [(f"2024-01-{d:02d}T00:00:00Z", f"10.0.0.{d}", u, "2024-02-01") for u, n in (("big", 20), ("small", 2), (None, 1)) for d in range(1, n + 1)]
    df = spark.createDataFrame([*rows, (None, "10.0.0.1", "small", "2024-02-01")], "ts string, ip_addr string, username string, snapshot_date string")
    named = B.with_sized_document_names(df, 5).collect()
    assert len(named) == 24 and {r.file_name for r in named if r.username == "small"} == {"history_2024-01_0.json", None}
    assert 1 < len({r.file_name for r in named if r.username == "big"}) <= 4


def land(root, user, snapshot, name, body):
    os.makedirs(f"{root}/{user}/{snapshot}", exist_ok=True)
    with open(f"{root}/{user}/{snapshot}/{name}", "wb") as f:
        f.write(body)


def test_tasks_list_what_the_binary_source_lists(spark, tmp_path):
    from histlake.sources.landing import export_files
    from histlake.sources.listing import list_files
    root = str(tmp_path)
    for user in ("007", "ana maria", "c+d", "100%25", "_hidden", ".hidden", "_k=v"):
        for name in ("a.json", "b c%41.json", "_c.json", ".d.json", "notes.txt"):
            land(root, user, "2024-01-01", name, user.encode())
    land(root, "007", "2024-01-01", "none.json", b"")
    land(root, "007/deeper", "2024-01-01", "e.json", b"e")
    with open(f"{root}/top.json", "wb") as f:
        f.write(b"[]")
    source = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(root)
    expected = sorted(map(tuple, source.select("path", "modificationTime", "length").collect()))
    assert len(expected) == 12 and sorted(map(tuple, list_files(spark, root).collect())) == expected
    bodies = {r.path: bytes(r.content) for r in source.select("path", "content").collect()}
    assert {r.path: bytes(r.body) for r in export_files(spark, root).collect()} == bodies
    # neither a file listing in the driver nor the file source's packing of small files is left
    assert "binaryFile" not in export_files(spark, root)._jdf.queryExecution().executedPlan().toString()


def test_rejects_of_both_kinds_come_from_one_pass(spark, tmp_path):
    land(str(tmp_path), "u", "2024-01-01", "a.json", b'[{"ts": "t"}, 5, null]')
    land(str(tmp_path), "u", "2024-01-01", "b.json", b"[")
    rejects = read_landing(spark, str(tmp_path)).rejects
    found = sorted((r.file_name, r.reason, r.position, r.n_chars, r["sample"]) for r in rejects.collect())
    assert found == [("a.json", "not an object", 1, 1, "5"), ("a.json", "not an object", 2, None, None), ("b.json", "not json", -1, 1, "[")]
    assert "Union" not in rejects._jdf.queryExecution().executedPlan().toString()


def test_absent_root_is_an_analysis_error(spark, tmp_path):
    import pytest
    from pyspark.sql.utils import AnalysisException
    with pytest.raises(AnalysisException):
        read_landing(spark, str(tmp_path / "none"))


def test_small_batches_of_many_users_share_files(spark):
    from histlake.sources.silver_table import SilverTable
    table = SilverTable(spark, scratch_dir(spark, "test-shared-table"))

    def plays(lo, hi):
        rows = spark.range(lo, hi).select(F.concat(F.lit("s"), "id").alias("stream_id"),
                                          F.when(F.col("id") != 7, F.concat(F.lit("u"), "id")).alias("username"),
                                          F.when(F.col("id") != 8, F.lit(2023)).alias("streamed_year"))
        return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER_SCHEMA])

    def take(rows, name, shared):
        table.commit(table.stage(rows, shared=shared), name, shared=shared)

    take(plays(0, 20), "whole", False)
    for i in range(3):                                       # each takes 10 plays of the batch before again
        take(plays(50 * i, 50 * i + 60), f"small-{i}", True)
    table.stage(plays(300, 330), shared=True)                # died before its commit
    assert sorted(r.stream_id for r in table.plays().collect()) == sorted(f"s{i}" for i in range(160))
    assert {(r.stream_id, r.username, r.streamed_year) for r in table.plays().where("stream_id in ('s7', 's8', 's9')").collect()} == {
        ("s7", None, 2023), ("s8", "u8", None), ("s9", "u9", 2023)}
    assert len(files_below(f"{table.root}/shared")) <= 12
    assert table.new_plays(plays(0, 165)).count() == 5 and table.watermarks().count() == 160
    table.compact()                                          # folders by user again
    assert table.plays().count() == 160 and table.plays().where("username = 'u150'").count() == 1
    assert "username" in table.plays().where("username = 'u150'")._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters: [")[1].split("]")[0]
    assert not table.merge(plays(0, 1), "small-1")


def test_stream_writes_no_folder_per_user(spark, tmp_path):
    import json

    from histlake.streaming.silver_stream import run_silver_stream
    for i in range(30):
        folder = tmp_path / f"u{i}" / "2024-01-01"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps([{"ts": "2024-01-01T00:00:00Z", "ms_played": i}]))
    table = run_silver_stream(spark, str(tmp_path), scratch_dir(spark, "test-many"), scratch_dir(spark, "test-many-ck"), 15)
    assert table.plays().count() == 30 and table.version() == 2 and not any("username=" in d for d, _, _ in os.walk(table.root))
    tasks = int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"))
    assert tasks <= 4 * spark.sparkContext.defaultParallelism


def pairs_of_one_day(spark, how, order=()):
    from histlake.operators.joins import interval_join
    events = spark.range(400, numPartitions=1).select(F.col("id").alias("e"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 37 % 4000).alias("at"))
    events = events.union(spark.sql("SELECT 400L, CAST(NULL AS timestamp) UNION ALL SELECT 401L, timestamp '2024-03-01 00:00:00' UNION ALL SELECT 7L, timestamp '2024-01-01 00:04:19'"))
    intervals = spark.range(60, numPartitions=1).select(F.col("id").alias("i"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 50).alias("start_at"),
                                                        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 80).alias("end_at"))
    inside = (F.col("at") >= F.col("start_at")) & (F.col("at") <= F.col("end_at"))
    want = sorted(map(str, events.join(intervals, inside, how).select("e", "at", "i", "start_at", "end_at").collect()))
    return interval_join(events, intervals, "at", how=how, order=order), want


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
def test_pairs_of_one_day_are_spread_over_tasks(spark, monkeypatch, how, small):
    from histlake.operators import joins
    if not small:
        monkeypatch.setattr(joins, "sized_broadcast", lambda df: df)
    found, want = pairs_of_one_day(spark, how)
    found = found.select("e", "at", "i", "start_at", "end_at")
    assert sorted(map(str, found.collect())) == want
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # it would gather so little data
    try:
        spread = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    if small:      # else AQE may broadcast so few intervals after all
        assert len(spread) > 3 and max(r["count"] for r in spread) < 0.5 * len(want)


@pytest.mark.parametrize("small", [True, False])
def test_events_are_sorted_not_their_pairs(spark, monkeypatch, small):
    from histlake.operators import joins
    if not small:
        monkeypatch.setattr(joins, "sized_broadcast", lambda df: df)
    found, want = pairs_of_one_day(spark, "inner", ["at", "e"])
    rows = found.select("e", "at", "i", "start_at", "end_at").collect()
    assert sorted(map(str, rows)) == want and [(r.at, r.e) for r in rows] == sorted((r.at, r.e) for r in rows)
    if small:
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Sort" not in plan.split("BroadcastHashJoin")[0] and "rangepartitioning(at" in plan.split("BroadcastHashJoin")[1]


def test_per_file_folders_are_written_and_read_by_tasks(spark, monkeypatch):
    odd = ["007", "ana maria", "c+d", "50%", "%2F", "a/b=c", "x'y\"", "é:#?", "{[^]}\\*", "tab\tnew\n", "", None]
    path = scratch_dir(spark, "test-per-file")

    def rows(users, ts):
        own = spark.createDataFrame([(u, s, f) for u in users for s in ("2024-01-01", "2024-02-01") for f in ("a.json", None)], "username string, snapshot_date string, source_file string")
        own = own.crossJoin(spark.createDataFrame([(t,) for t in ts], "ts string"))
        return own.select(*[F.col(c) if c in own.columns else F.lit(None).cast("string").alias(c) for c in BRONZE_SCHEMA.fieldNames()], "source_file")

    def seen(df):
        return sorted(map(str, df.select("username", "snapshot_date", "source_file", "ts").collect()))

    none = F.when(F.col("username") != "", F.col("username"))      # a folder does not tell '' from null
    first, again = rows([*odd, *[f"u{i}" for i in range(60)]], ["1", "2"]), rows(["u1", "007"], ["3"])
    monkeypatch.setattr(sinks, "ROWS_PER_BATCH", 7)
    sinks.write_bronze_files(first, path, "source_file")
    back = sinks.read_bronze_files(spark, path, "source_file")
    assert seen(back) == seen(first.withColumn("username", none))
    assert back.columns == [*BRONZE_SCHEMA.fieldNames(), "source_file"] and len(back.inputFiles()) < 50     # not one per folder
    plain = spark.read.schema(back.schema).parquet(path)
    assert seen(plain) == seen(back)
    # partitions written again are replaced, the others stay, nothing is left over
    sinks.write_bronze_files(again, path, "source_file")
    sinks.write_bronze_files(again, path, "source_file")
    back = sinks.read_bronze_files(spark, path, "source_file")
    assert seen(back) == seen(first.where("username is null or username not in ('u1', '007')").withColumn("username", none).unionByName(again))
    assert not [d for d in os.listdir(path) if d.startswith(".")]
    one = sinks.read_bronze_files(spark, path, "source_file", (F.col("username") == "a/b=c") & F.col("source_file").isNull())
    assert sorted(r.ts for r in one.collect()) == ["1", "1", "2", "2"]
    # what another writer has put there is replaced, too
    before = seen(back)
    sinks.write_partitions(first.where("username in ('u1', '007')"), path, [*sinks.BRONZE_PARTITIONS, "source_file"], "ts")
    sinks.write_bronze_files(again, path, "source_file")
    assert seen(sinks.read_bronze_files(spark, path, "source_file")) == before


def test_a_large_file_is_split_and_not_held(spark, monkeypatch):
    path = scratch_dir(spark, "test-per-file")
    monkeypatch.setattr(sinks, "MAX_RECORDS_PER_FILE", 300)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        rows = bronze(spark, 1000).withColumn("username", F.lit("u")).withColumn("ts", F.format_string("%04d", F.monotonically_increasing_id())).withColumn("name", F.lit("a"))
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        sinks.write_bronze_files(rows, path, "name")
        assert sorted(r.ts for r in sinks.read_bronze_files(spark, path, "name").collect()) == sorted(r.ts for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len([f for f in files_below(path) if f.endswith(".parquet")]) >= 4


def test_batches_of_many_users_share_files(spark, monkeypatch):
    from histlake.sources import silver_table
    monkeypatch.setattr(silver_table, "MOST_FOLDERS", 20)
    base = {f.name: F.lit(None).cast(f.dataType) for f in SILVER_SCHEMA}

    def plays(first, end, year=2024):
        return spark.range(first, end).select(*[c.alias(n) for n, c in (base | {
            "stream_id": F.col("id").cast("string"), "username": F.concat(F.lit("u"), F.col("id").cast("string")),
            "streamed_year": F.when(F.col("id") % 7 > 0, F.lit(year))}).items()])

    table = silver_table.SilverTable(spark, scratch_dir(spark, "test-many-users"))
    assert table.merge(plays(0, 10), "few") and table.merge(plays(5, 105), "many") and not table.merge(plays(5, 105), "many")
    table = silver_table.SilverTable(spark, table.root)
    assert table.merge(plays(90, 112), "again")
    folders = {part: sorted(os.listdir(f"{table.root}/{part}")) for part in ("plays", "shared")}
    assert folders == {"plays": ["batch=1"], "shared": ["batch=2", "batch=3"]}
    assert len(files_below(f"{table.root}/shared")) < 20
    rows = sorted((int(r.stream_id), r.username, r.streamed_year) for r in table.plays().collect())
    assert rows == [(i, f"u{i}", 2024 if i % 7 else None) for i in range(112)]
    table.compact()
    assert table.version() == 4 and sorted(int(r.stream_id) for r in table.plays().collect()) == list(range(112))
    table.compact()                          # one batch that shares files is as good as it gets
    assert table.version() == 4


def test_a_micro_batch_leaves_one_file_a_folder(spark, tmp_path):
    from histlake.streaming.bronze_stream import run_available_now
    for i in range(300):
        land(str(tmp_path / "in"), f"u{i}", "2024-01-01", "a.json", b'[{"ts": "%d"}]' % i)
    plays = run_available_now(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted((r.username, r.ts) for r in plays.collect()) == sorted((f"u{i}", str(i)) for i in range(300))
    assert len([f for f in files_below(str(tmp_path / "out")) if f.endswith(".parquet")]) <= sinks.USER_BUCKETS
