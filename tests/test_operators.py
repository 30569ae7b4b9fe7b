"""Operator semantics on small hand-made fixtures, checked against plain
Python / brute-force Spark forms."""

import datetime as dt
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histlake.functions.casts import clean_offline_timestamp, parse_flag
from histlake.functions.keys import surrogate_key
from histlake.functions.paths import path_components
from histlake.operators import changes, dedup, joins, profile, quantiles, segments, years

UTC = dt.timezone.utc


def test_flags_strict_and_compat(spark):
    vals = ["True", "False", "None", "", None, "junk"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = df.select(parse_flag("v").alias("s"), parse_flag("v", compat=True).alias("c")).collect()
    assert [r.s for r in got] == [True, False, None, None, None, None]
    assert [r.c for r in got] == [True, True, True, False, False, True]


def test_offline_timestamp_rounds_half_even(spark):
    vals = ["1.5", "2.5", "nan", "abc", None, "3.0", "1704067207.5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.x for r in df.select(clean_offline_timestamp("v").alias("x")).collect()]
    assert got == [2, 2, None, None, None, 3, 1704067208]


def _python_key(row):
    """The exporter's text form: str() of each typed value joined by '-'."""
    def text(v, kind):
        if v is None:
            return "<NA>" if kind == "int" else "None"
        if kind == "ts":
            return v.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S+00:00")
        return str(v)
    kinds = {"ts": "ts", "ms_played": "int", "offline_timestamp": "int"}
    from histlake.schemas import KEY_COLUMNS
    s = "-".join(text(row[c], kinds.get(c, "x")) for c in KEY_COLUMNS)
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_matches_python_text_form(spark):
    from histlake.schemas import KEY_COLUMNS
    from histlake.schemas import FLAG_COLUMNS, INT_COLUMNS
    fields = []
    for c in KEY_COLUMNS:
        t = T.TimestampType() if c == "ts" else T.LongType() if c in INT_COLUMNS else \
            T.BooleanType() if c in FLAG_COLUMNS else T.StringType()
        fields.append(T.StructField(c, t))
    schema = T.StructType(fields)
    base = {c: f"v-{i}" for i, c in enumerate(KEY_COLUMNS)}
    base.update(ts=dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=UTC), ms_played=1234, offline_timestamp=None,
                shuffle=True, skipped=None, offline=False, incognito_mode=True)
    other = dict(base, ms_played=None, master_metadata_track_name=None, offline_timestamp=17)
    rows = [base, other]
    df = spark.createDataFrame([tuple(r[c] for c in KEY_COLUMNS) for r in rows], schema)
    got = [r.stream_id for r in surrogate_key(df).collect()]
    assert got == [_python_key(r) for r in rows]


def test_path_components_default_and_strict(spark):
    paths = ["raw/u1/2024-01-01/f.json", "u2/2024-02-02/g.json", "f.json"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    d = df.select(path_components("p").alias("c"), path_components("p", strict=True).alias("s")).collect()
    assert tuple(d[0].c) == ("u1", "2024-01-01", "f.json", False)
    assert tuple(d[1].c) == ("u2", "2024-02-02", "g.json", False)
    assert tuple(d[1].s) == ("", "2024-02-02", "g.json", True)
    assert tuple(d[2].c) == ("", "", "f.json", True)
    assert tuple(d[2].s) == ("", "", "", True)


def _ts(day, h=0, m=0, s=0, month=1):
    return dt.datetime(2024, month, day, h, m, s, tzinfo=UTC)


def test_long_intervals_do_not_explode_by_day(spark):
    far = dt.datetime(9999, 12, 31, tzinfo=UTC)
    events = spark.createDataFrame([(f"u{u}", _ts(1 + 3 * d)) for u in range(3) for d in range(4)], "username string, t timestamp")
    rows = [(f"u{u}", dt.datetime(2014, 1, 1, tzinfo=UTC), far if u == 0 else dt.datetime(2034, 1, 1, tzinfo=UTC), f"C{u}") for u in range(3)]
    iv = spark.createDataFrame(rows, "username string, start_at timestamp, end_at timestamp, code string")
    assert joins.filed_intervals(iv, "start_at", "end_at", 86_400).count() <= 2 * len(rows)
    touched = events.select("username", joins._bucket_number(F.col("t"), 86_400).alias("__bucket")).distinct()
    assert joins.intervals_by_bucket(touched, iv, "start_at", "end_at", ["username"], 86_400).count() == 12   # days with events
    assert joins.interval_join(events, iv, "t", keys=["username"], how="inner").count() == 12
    none = joins.interval_join(events.limit(0), iv, "t", keys=["username"])
    assert none.collect() == []
    assert joins.interval_join(events, iv.limit(0), "t", keys=["username"]).where("code IS NULL").count() == 12


def test_intervals_are_found_at_every_level(spark):
    rnd = random.Random(17)
    base = dt.datetime(2001, 1, 1, tzinfo=UTC)
    iv = []
    for i in range(120):     # from a second to eighty years
        a = base + dt.timedelta(seconds=rnd.randint(-10**9, 10**9))
        iv.append((f"u{i % 3}", a, a + dt.timedelta(seconds=int(10 ** rnd.uniform(0, 9.4))), i))
    ev = [(k, f"u{k % 4}", base + dt.timedelta(seconds=rnd.randint(-10**9, 2 * 10**9))) for k in range(300)]
    ev += [(1000 + i, u, a) for u, a, b, i in iv[:20]] + [(2000 + i, u, b) for u, a, b, i in iv[:20]] + [(3000, None, base), (3001, "u0", None)]
    got = joins.interval_join(spark.createDataFrame(ev, "id long, username string, t timestamp"),
                              spark.createDataFrame(iv, "username string, start_at timestamp, end_at timestamp, n long"), "t", keys=["username"])
    want = []
    for k, u, t in ev:
        hit = [i for v, a, b, i in iv if t is not None and u == v and a <= t <= b]
        want += [(k, i) for i in hit] or [(k, None)]
    assert sorted(((r.id, r.n) for r in got.collect()), key=str) == sorted(want, key=str)


def test_interval_links_count_and_name_all_pairs(spark):
    rnd = random.Random(23)
    iv = [(f"u{i}", _ts(1) + dt.timedelta(hours=rnd.randint(0, 200)), i) for i in range(30)]
    iv = [(u, a, a + dt.timedelta(hours=rnd.randint(-3, 90)), i) for u, a, i in iv]      # some reversed
    ev = [(k, _ts(1) + dt.timedelta(minutes=rnd.randint(-600, 20_000))) for k in range(300)]
    ev += [(500 + i, a) for _, a, _, i in iv] + [(600 + i, b) for _, _, b, i in iv] + [(900, None)]
    plays, members = joins.interval_links(
        spark.createDataFrame(ev, "id long, t timestamp"),
        spark.createDataFrame(iv, "username string, start_at timestamp, end_at timestamp, n long"), "t", ["id"])
    members = members.collect()
    assert len(members) == len(iv)
    rows = plays.collect()
    assert sorted(r.id for r in rows) == sorted(k for k, _ in ev)
    at = dict(ev)
    for r in rows:
        t = at[r.id]
        want = {i for _, a, b, i in iv if t is not None and a <= t <= b}
        assert r.n_links == (len(want) if t is not None else None)
        assert {m.n for m in members if r.segment is not None and m.first_segment is not None
                and m.first_segment <= r.segment <= m.last_segment} == want


def test_overlapping_intervals(spark):
    rows = [("a", _ts(1), _ts(5), 1), ("a", _ts(2), _ts(3), 2), ("a", _ts(4), _ts(9), 3), ("a", _ts(10), _ts(11), 4), ("b", _ts(1), _ts(5), 5),
            ("b", _ts(1), _ts(5), 6), ("b", _ts(7), _ts(6), 7)]
    df = spark.createDataFrame(rows, "username string, start_at timestamp, end_at timestamp, n int")
    assert sorted(r.n for r in joins.overlapping_intervals(df, ["username"]).collect()) == [2, 3, 6]


def test_interval_join_equals_nested_loop(spark):
    rnd = random.Random(7)
    events = [(i, f"u{rnd.randint(0, 3)}", _ts(1) + dt.timedelta(seconds=rnd.randint(0, 40 * 86400)))
              for i in range(400)]
    intervals = []
    for u in range(4):
        for _ in range(5):
            a = _ts(1) + dt.timedelta(seconds=rnd.randint(0, 40 * 86400))
            b = a + dt.timedelta(seconds=rnd.randint(-3600, 9 * 86400))  # some reversed
            intervals.append((f"u{u}", a, b, f"C{rnd.randint(0, 9)}"))
    # inclusive ends: one event exactly on a start and one on an end
    events.append((900, "u0", intervals[0][1]))
    events.append((901, "u0", intervals[0][2]))
    ev = spark.createDataFrame(events, "id long, username string, t timestamp")
    iv = spark.createDataFrame(intervals, "username string, start_at timestamp, end_at timestamp, code string")
    for keys in ([], ["username"]):
        ivk = iv if keys else iv.withColumnRenamed("username", "iuser")
        got = joins.interval_join(ev, ivk, "t", keys=keys, how="left")
        cond = (ev.t >= ivk.start_at) & (ev.t <= ivk.end_at)
        if keys:
            cond = cond & (ev.username == ivk.username)
        want = ev.join(ivk, cond, "left")
        cols = ["id", "start_at", "end_at", "code"]
        assert sorted(map(tuple, got.select(*cols).collect()), key=str) == \
            sorted(map(tuple, want.select(*cols).collect()), key=str)


def test_user_years_reversed_and_multi_year(spark):
    rows = [("a", dt.datetime(2020, 5, 1, tzinfo=UTC), dt.datetime(2022, 1, 1, tzinfo=UTC), "X"),
            ("b", dt.datetime(2023, 5, 1, tzinfo=UTC), dt.datetime(2021, 1, 1, tzinfo=UTC), "Y"),
            ("c", dt.datetime(2024, 6, 1, tzinfo=UTC), dt.datetime(2024, 2, 1, tzinfo=UTC), "Z")]
    df = spark.createDataFrame(rows, "username string, start_at timestamp, end_at timestamp, airport_code string")
    got = sorted(tuple(r) for r in years.user_years(df).collect())
    # a reversed interval inside one year still counts (only years are compared)
    assert got == [(2020, "a", "X"), (2021, "a", "X"), (2022, "a", "X"), (2024, "c", "Z")]
    assert [r.year for r in years.year_list(df).orderBy("year").collect()] == list(range(2020, 2025))


def test_segmented_lag_lead_equals_plain_window(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):  # one hot user, a few small ones
        u = "hot" if rnd.random() < 0.7 else f"u{rnd.randint(0, 4)}"
        rows.append((f"id{i:05d}", u, _ts(1) + dt.timedelta(minutes=rnd.randint(0, 20 * 24 * 60)),
                     rnd.choice(["A", "B", None])))
    rows += [("n1", None, _ts(2), "A"), ("n2", None, _ts(3), "B"), ("n3", "hot", None, "A"), ("n4", None, None, "B")]
    df = spark.createDataFrame(rows, "stream_id string, username string, streamed_at timestamp, c string")
    order = ["streamed_at", "stream_id"]
    for part in (["username"], []):
        w = Window.partitionBy(*part).orderBy(*order)
        want = sorted(map(tuple, df.select("stream_id", F.lag("c").over(w), F.lead("c").over(w)).collect()))
        for n in (1, 7, 40, 400):
            got = changes.lag_lead(df, part, order, "c", "lg", "ld", segments=n)
            assert sorted(map(tuple, got.select("stream_id", "lg", "ld").collect())) == want, (part, n)


def test_hot_day_of_one_user_is_spread_over_segments(spark):
    df = spark.range(20_000).select(
        F.col("id").cast("string").alias("stream_id"), F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("username"),
        (F.lit(_ts(1)) + F.make_dt_interval(secs=F.col("id") % 3600)).alias("streamed_at"))
    seg = segments.segmented(df, ["username", "streamed_at", "stream_id"], 10)
    sizes = [r["count"] for r in seg.where("username = 'hot'").groupBy(segments.SEGMENT).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 3 * 20_000 / 10


def test_running_totals_equal_one_window(spark):
    df = spark.range(3000).select(F.xxhash64("id").alias("o"), (F.col("id") % 7 - 3).alias("v"), F.lit(1).alias("one"))
    seg = segments.segmented(df, ["o"], 13)
    w = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = sorted(map(tuple, df.select("o", F.sum("v").over(w), F.sum("one").over(w)).collect()))
    got = segments.running_totals(seg, ["o"], {"s": "v", "n": "one"})
    assert sorted(map(tuple, got.select("o", "s", "n").collect())) == want
    assert segments.running_totals(segments.segmented(df.limit(0), ["o"]), ["o"], {"s": "v"}).count() == 0


def test_key_keeps_the_fraction_of_a_second(spark):
    from histlake.functions import keys
    df = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-02 03:04:05'), (timestamp'2024-01-02 03:04:05.1'), "
                   "(timestamp'2024-01-02 03:04:05.9'), (null) t(ts)")
    assert [r[0] for r in df.select(keys._part("ts", "ts")).collect()] == [
        "2024-01-02 03:04:05+00:00", "2024-01-02 03:04:05.100000+00:00", "2024-01-02 03:04:05.900000+00:00", "NaT"]


def test_numbered_rows_matches_row_number(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 50)}", rnd.choice(["s1", "s2", "s3"]),
             rnd.randint(0, 2)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, snap string, v int")
    got = dedup.numbered_rows(df, ["k"], ["snap"], chunk=37)
    w = Window.partitionBy("k").orderBy("snap", "v")
    want = df.withColumn("rn", F.row_number().over(w)).withColumn("count", F.count(F.lit(1)).over(Window.partitionBy("k")))
    cols = ["k", "snap", "v", "rn", "count"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    surplus = dedup.numbered_rows(df, ["k"], ["snap"], min_rn=2, only_duplicated=True)
    kept = dedup.keep_first(df, ["k"], ["snap"])
    assert surplus.count() + kept.count() == df.count()


def test_duplicate_rows_and_key_counts_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [("a", 1), ("b", 1), ("b", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    d = dedup.duplicate_rows(df, ["k"], "n")
    assert d.count() == 502 and {r.n for r in d.where("k='hot'").select("n").distinct().collect()} == {500}
    c = dedup.with_key_count(df, ["k"], "n")
    assert c.count() == 503


@pytest.mark.parametrize("few", [quantiles.FEW, 0])     # 0: limits, segments and totals for all
def test_exact_quantiles_match_numpy(spark, few):
    rnd = np.random.default_rng(11)
    vals = np.concatenate([rnd.integers(0, 50, 21_000), rnd.normal(100, 20, 9_000).round(2), np.full(9_000, 7.0)])
    groups = ["a" if i % 3 else "b" for i in range(len(vals))]
    df = spark.createDataFrame([(float(v), g) for v, g in zip(vals, groups, strict=True)] + [(None, "a"), (float("nan"), "b")], "x double, g string")
    q, extra = quantiles.exact_quantiles(df, "x", [0, 0.1, 0.25, 0.5, 0.999, 1], key="g", extra=[F.count("x").alias("n")], few=few)
    got = {(r.g, r.prob): r.quantile for r in q.collect()}
    assert len(got) == 12 and {r.g: r.n for r in extra.collect()} == {g: groups.count(g) for g in "ab"}
    for (g, p), x in got.items():
        assert abs(x - np.quantile(vals[np.array(groups) == g], p)) < 1e-9, (g, p)
    whole, _ = quantiles.exact_quantiles(df, "x", few=few)
    assert {r.prob: r.quantile for r in whole.collect()} == {p: np.quantile(vals, p) for p in quantiles.QUARTILES}


def test_quantiles_of_very_few_values(spark):
    for vals in ([], [5.0], [5.0, 7.0], [1.0, 1.0, 2.0]):
        q, _ = quantiles.exact_quantiles(spark.createDataFrame([(v,) for v in vals], "x double"), "x")
        assert {r.prob: r.quantile for r in q.collect()} == ({p: np.quantile(vals, p) for p in quantiles.QUARTILES} if vals else {})


def test_string_profile_top_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    r = profile.string_profile(df, ["s"]).collect()[0]
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_document_names_do_not_depend_on_group_size(spark):
    from histlake.sources import bindings as B
    rows = [(f"2024-01-{d:02d}T00:00:00Z", "u", "2024-02-01") for d in range(1, 32)]
    df = spark.createDataFrame(rows, "ts string, username string, snapshot_date string")
    named = {r.ts[8:10]: r.file_name for r in B.with_document_names(df).collect()}
    assert {n: [d for d in named if named[d] == n] for n in set(named.values())}.keys() == {f"history_2024-01_{i}.json" for i in range(4)}
    assert named["10"].endswith("_0.json") and named["11"].endswith("_1.json") and named["31"].endswith("_3.json")
    one = B.with_document_names(df.where("ts = '2024-01-11T00:00:00Z'")).first()
    assert one.file_name == named["11"]


def test_counted_casts_and_rejects(spark):
    from histlake.functions.casts import cast_rejects, counted_casts
    from histlake.schemas import BRONZE_SCHEMA
    good = dict.fromkeys(BRONZE_SCHEMA.fieldNames(), None) | {
        "ts": "2024-01-02T03:04:05Z", "ms_played": "5", "shuffle": "True", "offline_timestamp": "1.5", "username": "u", "snapshot_date": "2024-02-01"}
    rows = [good, good | {"ms_played": "5.5", "shuffle": "perhaps"}, good | {"ts": "x", "offline_timestamp": "inf"},
            good | {"ts": None, "ms_played": "None", "offline_timestamp": "nan", "shuffle": ""}, good | {"snapshot_date": "soon"}]
    df = spark.createDataFrame([tuple(r[c] for c in BRONZE_SCHEMA.fieldNames()) for r in rows], BRONZE_SCHEMA)
    typed, counts = counted_casts(df)
    assert typed.count() == 5 and typed.where("ms_played = 5").count() == 3
    typed.write.format("noop").mode("overwrite").save()
    got = counts.get
    assert got["rows"] == 5
    assert {c: got[f"{c}.failed"] for c in ("ts", "ms_played", "shuffle", "offline_timestamp", "snapshot_date", "skipped")} == {
        "ts": 1, "ms_played": 1, "shuffle": 1, "offline_timestamp": 1, "snapshot_date": 1, "skipped": 0}
    assert (got["ts.missing"], got["ms_played.missing"], got["shuffle.missing"], got["skipped.missing"]) == (1, 1, 1, 5)
    assert sorted((r.column_name, r.text) for r in cast_rejects(df).collect()) == [
        ("ms_played", "5.5"), ("offline_timestamp", "inf"), ("shuffle", "perhaps"), ("snapshot_date", "soon"), ("ts", "x")]


def test_force_requests_everything(spark):
    from histlake.operators import weather as WX
    keys = "year int, latitude double, longitude double"
    asked = spark.createDataFrame([(2024, 1.0, 2.0), (2024, 3.0, 4.0)], keys)
    daily, hourly = spark.createDataFrame([(2024, 1.0, 2.0)], keys), spark.createDataFrame([(2024, 1.0, 2.0)], keys)
    assert [tuple(r) for r in WX.missing_requests(asked, daily, hourly).collect()] == [(2024, 3.0, 4.0)]
    assert WX.missing_requests(asked, daily, hourly, force=True).count() == 2


def test_caller_predicate_is_a_column(spark):
    from histlake.plans.pipelines import located_plays
    from histlake.schemas import SILVER_SCHEMA
    row = {f: None for f in SILVER_SCHEMA.fieldNames()} | {"username": "u"}
    plays = spark.createDataFrame([tuple((row | {"stream_id": str(d), "streamed_at": _ts(d)}).values()) for d in (1, 5, 9)], SILVER_SCHEMA)
    places = spark.createDataFrame([("u", _ts(1), _ts(5), "LHR"), ("u", _ts(5), _ts(6), "LIM")],
                                   "username string, start_at timestamp, end_at timestamp, airport_code string")
    assert sorted((r.stream_id, r.airport_code) for r in located_plays(plays, places).collect() if r.airport_code) == [
        ("1", "LHR"), ("5", "LHR"), ("5", "LIM")]
    at = located_plays(plays, places, (F.col("airport_code") == "LHR") & (F.col("streamed_at") > F.lit(_ts(1))))
    assert [r.stream_id for r in at.collect()] == ["5"]


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    hint = lambda df: "UnresolvedHint" in df._jdf.queryExecution().logical().toString()
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert hint(joins.sized_broadcast(df))
    assert not hint(joins.sized_broadcast(df, max_rows=99)) and not hint(joins.sized_broadcast(df, max_bytes=50_000))
