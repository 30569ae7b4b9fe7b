"""DuckDB SQL that recomputes each registered query from the driver tables.

These strings are an independent second implementation used as the
correctness oracle (they re-derive the bindings in SQL; nothing is shared
with the Spark code).  Timestamps are naive UTC ``TIMESTAMP`` values.
"""

from __future__ import annotations

# -- bindings ---------------------------------------------------------------

RAW_PLAYS = """
raw_base AS (
  SELECT
    event_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts,
    CASE user_id % 4 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' WHEN 2 THEN 'windows' ELSE 'web_player' END AS platform,
    CAST(CAST(round(value * 1000) AS BIGINT) AS VARCHAR) AS ms_played,
    upper(substr(event_type, 1, 2)) AS conn_country,
    '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip_addr,
    CASE WHEN event_id % 7 = 0 THEN 'None' ELSE 'Track ' || json_extract_string(props, '$.k') END AS master_metadata_track_name,
    CASE WHEN event_id % 7 = 0 THEN 'None' ELSE 'Artist ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) END AS master_metadata_album_artist_name,
    CASE WHEN event_id % 7 = 0 THEN 'None' ELSE 'Album - ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS VARCHAR) END AS master_metadata_album_album_name,
    CASE WHEN event_id % 7 = 0 THEN 'None' ELSE 'uri:track:' || json_extract_string(props, '$.k') END AS spotify_track_uri,
    CASE WHEN event_id % 7 = 0 THEN 'Episode ' || json_extract_string(props, '$.k') ELSE 'None' END AS episode_name,
    CASE WHEN event_id % 7 = 0 THEN 'Show ' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) ELSE 'None' END AS episode_show_name,
    CASE WHEN event_id % 7 = 0 THEN 'uri:episode:' || json_extract_string(props, '$.k') ELSE 'None' END AS spotify_episode_uri,
    CASE event_id % 3 WHEN 0 THEN 'trackdone' WHEN 1 THEN 'clickrow' ELSE 'fwdbtn' END AS reason_start,
    CASE event_id % 4 WHEN 0 THEN 'trackdone' WHEN 1 THEN 'endplay' WHEN 2 THEN 'fwdbtn' ELSE 'logout' END AS reason_end,
    CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'False' END AS shuffle,
    CASE WHEN event_id % 11 = 0 THEN 'None' WHEN event_id % 3 = 0 THEN 'True' ELSE 'False' END AS skipped,
    CASE WHEN event_id % 5 = 0 THEN 'True' ELSE 'False' END AS offline,
    CASE WHEN event_id % 5 = 0 THEN 'nan'
         WHEN event_id % 13 = 0 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.5'
         ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.0' END AS offline_timestamp,
    CASE WHEN event_id % 17 = 0 THEN 'True' ELSE 'False' END AS incognito_mode,
    'user-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS username
  FROM events
),
raw_plays AS (
  SELECT * EXCLUDE (event_id), '2024-02-01' AS snapshot_date FROM raw_base
  UNION ALL
  SELECT * EXCLUDE (event_id), '2024-03-01' AS snapshot_date FROM raw_base WHERE event_id % 10 = 0
)"""

TEXT_COLS = [
    "platform", "conn_country", "ip_addr", "master_metadata_track_name",
    "master_metadata_album_artist_name", "master_metadata_album_album_name",
    "spotify_track_uri", "episode_name", "episode_show_name", "spotify_episode_uri",
    "reason_start", "reason_end",
]

TYPED = """
typed AS (
  SELECT
    CAST(strptime(ts, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts,
    platform, TRY_CAST(ms_played AS BIGINT) AS ms_played, conn_country, ip_addr,
    master_metadata_track_name, master_metadata_album_artist_name, master_metadata_album_album_name,
    spotify_track_uri, episode_name, episode_show_name, spotify_episode_uri, reason_start, reason_end,
    TRY_CAST(shuffle AS BOOLEAN) AS shuffle, TRY_CAST(skipped AS BOOLEAN) AS skipped,
    TRY_CAST(offline AS BOOLEAN) AS offline,
    CASE WHEN isnan(TRY_CAST(offline_timestamp AS DOUBLE)) THEN NULL
         ELSE CAST(round_even(TRY_CAST(offline_timestamp AS DOUBLE), 0) AS BIGINT) END AS offline_timestamp,
    TRY_CAST(incognito_mode AS BOOLEAN) AS incognito_mode,
    username,
    CAST(snapshot_date AS TIMESTAMP) AS snapshot_date
  FROM raw_plays
)"""


def _flag(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'None' WHEN {c} THEN 'True' ELSE 'False' END"


KEY_PARTS = ",\n      ".join(
    ["strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00'", "coalesce(platform, 'None')",
     "coalesce(CAST(ms_played AS VARCHAR), '<NA>')"]
    + [f"coalesce({c}, 'None')" for c in TEXT_COLS[1:]]
    + [_flag("shuffle"), _flag("skipped"), _flag("offline"),
       "coalesce(CAST(offline_timestamp AS VARCHAR), '<NA>')", _flag("incognito_mode"),
       "coalesce(username, 'None')"]
)

KEYED = f"""
keyed AS (
  SELECT md5(concat_ws('-',
      {KEY_PARTS})) AS stream_id, *
  FROM typed
)"""

SILVER_SELECT = """stream_id, CAST(year(ts) AS INTEGER) AS streamed_year, ts AS streamed_at,
    platform, ms_played, conn_country, ip_addr, master_metadata_track_name,
    master_metadata_album_artist_name, master_metadata_album_album_name, spotify_track_uri,
    episode_name, episode_show_name, spotify_episode_uri, reason_start, reason_end,
    shuffle, skipped, offline, incognito_mode, username, offline_timestamp"""

SILVER = f"""
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY snapshot_date) AS rn FROM keyed
  ) WHERE rn = 1
),
silver AS (
  SELECT {SILVER_SELECT} FROM dedup
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


PLAYS = (RAW_PLAYS, TYPED, KEYED)
SILVER_CTES = (*PLAYS, SILVER)


def silver_sql(select: str) -> str:
    return with_ctes(*SILVER_CTES) + "\n" + select


def plays_sql(select: str) -> str:
    return with_ctes(*PLAYS) + "\n" + select


ORACLE: dict[str, str] = {}

ORACLE["silver_streams"] = silver_sql("SELECT * FROM silver")

ORACLE["type_cast_streams"] = plays_sql("SELECT * FROM typed")
ORACLE["offline_timestamp_clean"] = plays_sql("""
SELECT r.username, r.ts, r.snapshot_date, r.offline_timestamp AS offline_timestamp_raw,
       CASE WHEN isnan(TRY_CAST(r.offline_timestamp AS DOUBLE)) THEN NULL
            ELSE CAST(round_even(TRY_CAST(r.offline_timestamp AS DOUBLE), 0) AS BIGINT) END AS offline_timestamp
FROM raw_plays r""")
ORACLE["surrogate_key"] = plays_sql("SELECT username, ts, snapshot_date, stream_id FROM keyed")
ORACLE["streamed_year"] = silver_sql("SELECT stream_id, streamed_at, streamed_year FROM silver")
ORACLE["dedup_by_stream_id"] = silver_sql("SELECT * EXCLUDE (rn) FROM dedup")
ORACLE["duplicate_members"] = plays_sql("""
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY stream_id) AS count_by_stream_id FROM keyed)
WHERE count_by_stream_id > 1""")
ORACLE["duplicate_surplus"] = plays_sql("""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY stream_id ORDER BY snapshot_date) AS INTEGER) AS rn_by_stream_id,
         count(*) OVER (PARTITION BY stream_id) AS count_by_stream_id
  FROM keyed)
WHERE rn_by_stream_id > 1""")
ORACLE["duplicate_ts"] = plays_sql("""
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY ts) AS count_by_ts FROM typed)
WHERE count_by_ts > 1""")
ORACLE["dedup_by_ts"] = plays_sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY username, ts ORDER BY snapshot_date) AS rn FROM typed)
WHERE rn = 1""")
ORACLE["streamed_at_count"] = silver_sql("""
SELECT stream_id, streamed_at, count(*) OVER (PARTITION BY username, streamed_at) AS count_by_streamed_at FROM silver""")


def _changes(by: str) -> str:
    """Every play numbered in its timeline and joined to the next numbers."""
    same = "TRUE" if by == "TRUE" else "a.username = b.username"
    return silver_sql(f"""
, line AS (
  SELECT stream_id, username, streamed_at, conn_country,
         row_number() OVER (PARTITION BY {by} ORDER BY streamed_at, stream_id) AS place FROM silver),
same_time AS (SELECT username, streamed_at, count(*) AS n FROM silver GROUP BY ALL)
SELECT b.stream_id, b.username, b.streamed_at, b.conn_country, a.conn_country AS lag_conn_country,
       c.conn_country AS lead_conn_country, t.n AS count_by_streamed_at
FROM line b
JOIN line a ON {same} AND a.place = b.place - 1
LEFT JOIN line c ON {same.replace('a.', 'c.')} AND c.place = b.place + 1
JOIN same_time t ON t.username = b.username AND t.streamed_at = b.streamed_at
WHERE b.conn_country = 'CL' AND a.conn_country <> 'CL'""")


ORACLE["country_change"] = _changes("username")
ORACLE["country_change_global"] = _changes("TRUE")
ORACLE["cutoff_filter_desc"] = silver_sql("""
SELECT * FROM silver WHERE streamed_at < TIMESTAMP '2024-01-15' ORDER BY streamed_at DESC, stream_id DESC""")
ORACLE["filter_user_snapshot"] = plays_sql("""
SELECT * FROM raw_plays WHERE username = 'user-000007' AND snapshot_date = '2024-03-01'""")
ORACLE["bronze_users_pruned"] = plays_sql("""
SELECT r.* FROM raw_plays r
WHERE CAST(right(r.username, 6) AS INTEGER) IN (
  SELECT user_id FROM events, (VALUES (0), (1), (2)) o(k) WHERE (user_id + o.k) % 27 = 3)""")
ORACLE["missing_track_filter"] = plays_sql("""
SELECT * FROM raw_plays
WHERE master_metadata_track_name IS NULL OR master_metadata_track_name IN ('', 'None')""")
ORACLE["missing_track_head"] = plays_sql("""
SELECT * FROM raw_plays
WHERE master_metadata_track_name IS NULL OR master_metadata_track_name IN ('', 'None')
ORDER BY ts, username, snapshot_date, ip_addr, ms_played LIMIT 5""")

# -- locations, years -------------------------------------------------------

AIRPORTS = """
airports AS (
  SELECT 'AP' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS airport_code,
         CAST(n_nationkey % 20 AS DOUBLE) * CAST(2.5 AS DOUBLE) - CAST(20.0 AS DOUBLE) + CAST(0.123456 AS DOUBLE) AS latitude,
         CAST(n_nationkey AS DOUBLE) * CAST(7.123456 AS DOUBLE) - CAST(80.0 AS DOUBLE) AS longitude
  FROM nation
)"""

CUST_LOC = """
cust_loc AS (
  SELECT 'cust-' || lpad(CAST(o.o_custkey AS VARCHAR), 7, '0') AS username,
         min(o.o_orderdate) AS start_at, max(o.o_orderdate) AS end_at,
         'AP' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS airport_code
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY o.o_custkey, c.c_nationkey
)"""

USER_LOC = """
uloc AS (
  SELECT 'user-' || lpad(CAST(u.user_id AS VARCHAR), 6, '0') AS username,
         make_timestamp((1704067200 + (u.user_id % 24) * 3600 + o.s) * 1000000) AS start_at,
         make_timestamp((1704067200 + (u.user_id % 24) * 3600 + o.e) * 1000000) AS end_at,
         'AP' || lpad(CAST((u.user_id + o.k) % 27 AS VARCHAR), 2, '0') AS airport_code
  FROM (SELECT DISTINCT user_id FROM events) u
  CROSS JOIN (VALUES (0, 0, 863999), (1, 820800, 1727999), (2, 1814400, 2678399)) o(k, s, e)
)"""

# Independent of the operators: years come from generate_series, per interval
# and over the whole span.
YEARS_LIST = """
calendar AS (
  SELECT CAST(unnest(generate_series(year(min(start_at)), greatest(year(min(start_at)), year(max(end_at))))) AS INTEGER) AS year
  FROM cust_loc
)"""

YEARS_CODE = """
touched AS (
  SELECT airport_code, unnest(generate_series(year(start_at), year(end_at))) AS y FROM cust_loc
),
touched_years AS (SELECT CAST(y AS INTEGER) AS year, airport_code FROM touched GROUP BY ALL),
touched_places AS (
  SELECT year, airport_code, latitude, longitude FROM airports JOIN touched_years USING (airport_code)
)"""


def recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes)


ORACLE["year_bounds"] = with_ctes(CUST_LOC) + """
SELECT CAST(year(min(start_at)) AS INTEGER) AS min_year, CAST(year(max(end_at)) AS INTEGER) AS max_year FROM cust_loc"""
ORACLE["year_list"] = recursive(CUST_LOC, YEARS_LIST) + "\nSELECT year FROM calendar"
ORACLE["user_years_expand"] = recursive(CUST_LOC, YEARS_LIST) + """
SELECT y.year, u.username, u.airport_code
FROM calendar y JOIN cust_loc u ON y.year BETWEEN year(u.start_at) AND year(u.end_at)
ORDER BY username, year"""
ORACLE["years_code_distinct"] = recursive(CUST_LOC, YEARS_LIST, YEARS_CODE) + "\nSELECT year, airport_code FROM touched_years"
YEAR_COORDINATES_SQL = recursive(AIRPORTS, CUST_LOC, YEARS_LIST, YEARS_CODE) + """
SELECT year, airport_code, latitude, longitude FROM touched_places ORDER BY year, latitude"""
ORACLE["year_coordinates"] = YEAR_COORDINATES_SQL
ORACLE["years_csv_roundtrip"] = YEAR_COORDINATES_SQL
ORACLE["airports_csv_scan"] = with_ctes(AIRPORTS) + "\nSELECT * FROM airports"
ORACLE["user_location_csv_scan"] = with_ctes(USER_LOC) + "\nSELECT * FROM uloc"

LOC_SELECT = """p.stream_id, p.username, p.streamed_at, p.ms_played, p.ip_addr, p.conn_country,
       l.start_at, l.end_at, l.airport_code, p.master_metadata_track_name, p.master_metadata_album_artist_name"""

ORACLE["location_interval_join"] = with_ctes(*SILVER_CTES, USER_LOC) + f"""
SELECT {LOC_SELECT}, l.username AS location_username
FROM silver p LEFT JOIN uloc l ON p.streamed_at BETWEEN l.start_at AND l.end_at"""
ORACLE["location_interval_filtered"] = with_ctes(*SILVER_CTES, USER_LOC) + f"""
SELECT {LOC_SELECT}, l.username AS location_username
FROM silver p LEFT JOIN uloc l ON p.streamed_at BETWEEN l.start_at AND l.end_at
WHERE l.airport_code = 'AP03'
ORDER BY p.streamed_at, p.stream_id"""
ORACLE["location_interval_members"] = with_ctes(USER_LOC) + """
, cuts AS (
  SELECT t, row_number() OVER (ORDER BY t) AS n
  FROM (SELECT start_at AS t FROM uloc UNION SELECT end_at + INTERVAL 1 MICROSECOND FROM uloc))
SELECT l.*, a.n AS first_segment, b.n - 1 AS last_segment
FROM uloc l JOIN cuts a ON a.t = l.start_at JOIN cuts b ON b.t = l.end_at + INTERVAL 1 MICROSECOND"""
ORACLE["location_user_interval_join"] = with_ctes(*SILVER_CTES, USER_LOC) + f"""
SELECT {LOC_SELECT}
FROM silver p LEFT JOIN uloc l
  ON p.username = l.username AND p.streamed_at BETWEEN l.start_at AND l.end_at
ORDER BY p.streamed_at, p.stream_id"""
ORACLE["location_user_filtered"] = with_ctes(*SILVER_CTES, USER_LOC) + f"""
SELECT {LOC_SELECT}
FROM silver p JOIN uloc l
  ON p.username = l.username AND p.streamed_at >= l.start_at AND p.streamed_at <= l.end_at
WHERE l.airport_code = 'AP03' AND p.streamed_at >= TIMESTAMP '2024-01-15' AND p.streamed_at < TIMESTAMP '2024-01-22'"""

CUST_PRIORITY = """
spans AS (
  SELECT 'cust-' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS username, o_orderpriority AS priority,
         min(o_orderdate) AS start_at, max(o_orderdate) AS end_at FROM orders GROUP BY o_custkey, o_orderpriority)"""
ORACLE["long_intervals_join"] = with_ctes(CUST_PRIORITY) + """
SELECT s.username, o.o_orderkey, o.o_orderdate AS placed_at, s.priority, s.start_at, s.end_at
FROM orders o JOIN spans s ON s.username = 'cust-' || lpad(CAST(o.o_custkey AS VARCHAR), 7, '0')
  AND o.o_orderdate BETWEEN s.start_at AND s.end_at"""
ORACLE["location_overlaps"] = with_ctes(USER_LOC) + """
SELECT l.*, (SELECT max(e.end_at) FROM uloc e WHERE e.username = l.username AND e.start_at < l.start_at) AS covered_until
FROM uloc l WHERE EXISTS (
  SELECT 1 FROM uloc e WHERE e.username = l.username AND e.start_at < l.start_at AND e.end_at >= l.start_at)"""

# -- weather ----------------------------------------------------------------

WEATHER = """
stations AS (
  SELECT e.ts, e.value, a.airport_code, a.latitude, a.longitude
  FROM events e JOIN airports a ON a.airport_code = 'AP' || lpad(CAST(e.user_id % 25 AS VARCHAR), 2, '0')
),
wdaily AS (
  SELECT airport_code, CAST(d AS TIMESTAMP) AS date,
    CASE WHEN day(d) = 13 THEN NULL ELSE CAST(n AS DOUBLE) END AS weather_code,
    strftime(d, '%Y-%m-%d') || 'T07:' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') AS sunrise,
    strftime(d, '%Y-%m-%d') || 'T17:' || lpad(CAST(n % 37 AS VARCHAR), 2, '0') AS sunset,
    vmax * CAST(100.0 AS DOUBLE) AS daylight_duration, vmax AS sunshine_duration,
    CAST(year(d) AS INTEGER) AS year, round(latitude, 3) AS latitude, round(longitude, 3) AS longitude,
    'daily' AS frequency
  FROM (SELECT airport_code, latitude, longitude, CAST(ts AS DATE) AS d, count(*) AS n, max(value) AS vmax
        FROM stations GROUP BY airport_code, latitude, longitude, CAST(ts AS DATE))
),
whourly AS (
  SELECT airport_code, h AS datetime, vmin AS temperature_2m, CAST(n AS DOUBLE) AS cloud_cover,
    CAST(year(h) AS INTEGER) AS year, round(latitude, 3) AS latitude, round(longitude, 3) AS longitude,
    'hourly' AS frequency
  FROM (SELECT airport_code, latitude, longitude, date_trunc('hour', ts) AS h, count(*) AS n, min(value) AS vmin
        FROM stations GROUP BY airport_code, latitude, longitude, date_trunc('hour', ts))
),
present AS (
  SELECT DISTINCT year, latitude, longitude FROM wdaily WHERE longitude > -60
  INTERSECT
  SELECT DISTINCT year, latitude, longitude FROM whourly WHERE longitude < 60
),
wreq AS (
  SELECT DISTINCT CAST(2024 AS INTEGER) AS year, u.airport_code, round(a.latitude, 3) AS latitude,
         round(a.longitude, 3) AS longitude
  FROM uloc u JOIN airports a ON a.airport_code = u.airport_code
)"""

WX_CTES = (AIRPORTS, USER_LOC, WEATHER)
DAILY_COLS = "date, weather_code, sunrise, sunset, daylight_duration, sunshine_duration, year, latitude, longitude, frequency"

ORACLE["weather_daily_flatten"] = with_ctes(*WX_CTES) + f"\nSELECT {DAILY_COLS} FROM wdaily"
ORACLE["weather_hourly_flatten"] = with_ctes(*WX_CTES) + """
SELECT datetime, temperature_2m, cloud_cover, year, latitude, longitude, frequency FROM whourly"""
ORACLE["weather_partitioned_write"] = ORACLE["weather_daily_flatten"]
ORACLE["weather_hourly_write"] = ORACLE["weather_hourly_flatten"]
ORACLE["weather_partition_lookup"] = with_ctes(*WX_CTES) + f"\nSELECT {DAILY_COLS} FROM wdaily WHERE airport_code = 'AP05'"
ORACLE["weather_present_semi"] = with_ctes(*WX_CTES) + "\nSELECT year, latitude, longitude FROM present"
ORACLE["missing_weather_anti"] = with_ctes(*WX_CTES) + """
SELECT r.year, r.airport_code, r.latitude, r.longitude FROM wreq r
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.year = r.year AND p.latitude = r.latitude AND p.longitude = r.longitude)"""
ORACLE["weather_completeness"] = with_ctes(*WX_CTES) + """
SELECT frequency, year, latitude, longitude, count(*) AS n_rows,
  CAST(CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 366 ELSE 365 END
       * CASE WHEN frequency = 'daily' THEN 1 ELSE 24 END AS INTEGER) AS expected_rows,
  count(*) >= CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 366 ELSE 365 END
       * CASE WHEN frequency = 'daily' THEN 1 ELSE 24 END AS complete
FROM (SELECT frequency, year, latitude, longitude FROM wdaily
      UNION ALL SELECT frequency, year, latitude, longitude FROM whourly)
GROUP BY frequency, year, latitude, longitude"""
ORACLE["weather_request_window"] = recursive(AIRPORTS, CUST_LOC, YEARS_LIST, YEARS_CODE) + """
SELECT year, airport_code, round(latitude, 3) AS latitude, round(longitude, 3) AS longitude,
       make_date(year, 1, 1) AS start_date, least(make_date(year, 12, 31), DATE '1999-06-30') AS end_date
FROM touched_places WHERE year <= 1999"""
ORACLE["weather_store_roundtrip"] = with_ctes(*WX_CTES) + f"""
SELECT {DAILY_COLS} FROM wdaily d
WHERE EXISTS (SELECT 1 FROM wreq r WHERE r.year = d.year AND r.latitude = d.latitude AND r.longitude = d.longitude)
  AND NOT EXISTS (SELECT 1 FROM present p WHERE p.year = d.year AND p.latitude = d.latitude AND p.longitude = d.longitude)"""
ORACLE["weather_store_hourly"] = with_ctes(*WX_CTES) + """
SELECT datetime, temperature_2m, cloud_cover, year, latitude, longitude, frequency FROM whourly h
WHERE h.longitude < 60 OR (
  EXISTS (SELECT 1 FROM wreq r WHERE r.year = h.year AND r.latitude = h.latitude AND r.longitude = h.longitude)
  AND NOT EXISTS (SELECT 1 FROM present p WHERE p.year = h.year AND p.latitude = h.latitude AND p.longitude = h.longitude))"""
ORACLE["weather_store_forced"] = with_ctes(*WX_CTES) + f"""
SELECT {DAILY_COLS} FROM wdaily d
WHERE EXISTS (SELECT 1 FROM wreq r WHERE r.year = d.year AND r.latitude = d.latitude AND r.longitude = d.longitude)"""


# -- profiles ----------------------------------------------------------------

def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ORACLE["category_counts"] = plays_sql(_union([
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM typed "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in ["conn_country", "reason_start", "reason_end"]]))
ORACLE["flag_value_counts"] = plays_sql(_union([
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS count FROM typed "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in ["shuffle", "skipped", "offline", "incognito_mode"]]))
RAW_COLS = ["ts", "platform", "ms_played", "conn_country", "ip_addr", "master_metadata_track_name",
            "master_metadata_album_artist_name", "master_metadata_album_album_name", "spotify_track_uri",
            "episode_name", "episode_show_name", "spotify_episode_uri", "reason_start", "reason_end",
            "shuffle", "skipped", "offline", "offline_timestamp", "incognito_mode", "username",
            "snapshot_date"]
ORACLE["missing_counts"] = plays_sql(_union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR {c} IN ('', 'None', 'nan')) "
    f"AS missing_count FROM raw_plays" for c in RAW_COLS]))
ORACLE["rounding_diff_sum"] = plays_sql("""
SELECT sum(x - round_even(x, 0)) AS rounding_diff_sum, count(x) AS n_values
FROM (SELECT CASE WHEN isnan(TRY_CAST(offline_timestamp AS DOUBLE)) THEN NULL
                  ELSE TRY_CAST(offline_timestamp AS DOUBLE) END AS x FROM raw_plays)""")
ORACLE["numeric_profile"] = plays_sql(_union([f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
  round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM typed WHERE {c} IS NOT NULL""" for c in ["ms_played", "offline_timestamp"]]))
ORACLE["timestamp_profile"] = plays_sql(_union([f"""
SELECT '{c}' AS column_name, count({c}) AS count,
  make_timestamp(CAST(sum(epoch_us({c})) // count({c}) AS BIGINT)) AS mean, min({c}) AS min,
  make_timestamp(CAST(floor(quantile_cont(CAST(epoch_us({c}) AS DOUBLE), 0.25)) AS BIGINT)) AS p25,
  make_timestamp(CAST(floor(quantile_cont(CAST(epoch_us({c}) AS DOUBLE), 0.5)) AS BIGINT)) AS p50,
  make_timestamp(CAST(floor(quantile_cont(CAST(epoch_us({c}) AS DOUBLE), 0.75)) AS BIGINT)) AS p75,
  max({c}) AS max
FROM typed WHERE {c} IS NOT NULL""" for c in ["ts", "snapshot_date"]]))
ORACLE["string_profile"] = plays_sql("""
, pairs AS (""" + _union([f"SELECT '{c}' AS column_name, {c} AS value FROM raw_plays WHERE {c} IS NOT NULL"
                          for c in RAW_COLS]) + """),
vc AS (SELECT column_name, value, count(*) AS cnt FROM pairs GROUP BY column_name, value)
SELECT column_name, CAST(sum(cnt) AS BIGINT) AS count, count(*) AS unique,
       first(value ORDER BY cnt DESC, value) AS top, max(cnt) AS freq
FROM vc GROUP BY column_name""")


# -- bronze layer, incremental -------------------------------------------------

DOC_NAME = "'history_' || substr(ts, 1, 7) || '_' || CAST((CAST(substr(ts, 9, 2) AS INTEGER) - 1) // 10 AS VARCHAR) || '.json'"
RAW_COLS_SQL = ", ".join(RAW_COLS)
EXPORTED = f"""
, exported AS (
  SELECT * REPLACE (CASE username WHEN 'user-000007' THEN '007' WHEN 'user-000008' THEN 'ana maria'
                                  WHEN 'user-000009' THEN 'c+d' ELSE username END AS username),
         {DOC_NAME} AS file_name FROM raw_plays),
documents_of AS (
  SELECT username, snapshot_date, file_name, count(*) AS n,
         CASE WHEN snapshot_date = '2024-03-01' AND starts_with(username, 'user-')
              THEN CASE right(username, 1) WHEN '3' THEN 'not json' WHEN '4' THEN 'empty' WHEN '6' THEN 'not an array'
                                           WHEN '1' THEN 'not an object' END END AS fault
  FROM exported GROUP BY ALL),
readable AS (
  SELECT e.* FROM exported e JOIN documents_of d USING (username, snapshot_date, file_name)
  WHERE d.fault IS NULL OR d.fault = 'not an object')
"""


def exported_sql(select: str) -> str:
    return plays_sql(EXPORTED + select)


ORACLE["bronze_json_scan"] = exported_sql("SELECT * FROM readable")
ORACLE["landing_rejects"] = exported_sql("""
SELECT username, snapshot_date, file_name, fault AS reason,
       CAST(CASE WHEN fault = 'not an object' THEN 0 ELSE -1 END AS INTEGER) AS position
FROM documents_of WHERE fault IS NOT NULL""")
ORACLE["landing_counts"] = exported_sql("""
SELECT 'documents' AS metric, count(*) AS n FROM documents_of
UNION ALL SELECT 'plays', count(*) FROM readable
UNION ALL SELECT r.reason, (SELECT count(*) FROM documents_of WHERE fault = r.reason)
FROM (VALUES ('empty'), ('not utf-8'), ('not json'), ('not an array'), ('not an object')) r(reason)""")
ORACLE["bronze_lines_scan"] = exported_sql("SELECT * FROM exported")
ORACLE["bronze_partitioned_write"] = plays_sql("SELECT * FROM raw_plays")
SIZED_DOC_NAME = ("'history_' || substr(ts, 1, 7) || '_' || CAST(CAST('0x' || substr(md5(ts || '|' || ip_addr), 1, 8) AS BIGINT)"
                  " % CAST(ceil(count(*) OVER (PARTITION BY username, snapshot_date, substr(ts, 1, 7)) / 50000.0) AS BIGINT)"
                  " AS VARCHAR) || '.json'")
ORACLE["bronze_per_file_write"] = plays_sql(f"SELECT *, {SIZED_DOC_NAME} AS source_file FROM raw_plays")
ORACLE["bronze_roundtrip"] = exported_sql("SELECT * EXCLUDE (file_name) FROM exported")
ORACLE["stream_bronze_available_now"] = exported_sql("SELECT * FROM exported")
ORACLE["silver_partitioned_write"] = silver_sql("SELECT * FROM silver")
ORACLE["external_table"] = silver_sql("SELECT * FROM silver")
ORACLE["path_components"] = exported_sql("""
, tails AS (
  SELECT *, username || '/' || snapshot_date || '/' || file_name AS tail, right(username, 1) = '5' AS bare FROM documents_of)
SELECT username, snapshot_date, file_name, CASE WHEN bare THEN tail ELSE 'raw/' || tail END AS path,
       username AS cut_username, false AS bad_path, CASE WHEN bare THEN '' ELSE username END AS strict_username,
       bare AS strict_bad_path FROM tails""")
ORACLE["file_manifest"] = exported_sql("""
SELECT username, file_name AS basename, TIMESTAMP '2024-12-10 12:00:00' AS processed_at, true AS path_fits, true AS snapshot_fits
FROM documents_of WHERE snapshot_date = '2024-02-01'""")
ORACLE["unprocessed_files_anti"] = exported_sql("""
SELECT username, snapshot_date, file_name AS basename FROM documents_of
WHERE snapshot_date <> '2024-02-01' OR right(username, 1) NOT IN ('0', '2', '4', '6', '8')""")
DELIVERED = """
, files AS (
  SELECT username, file_name AS basename, ts, d.snapshot_date, d.batch
  FROM exported e JOIN (VALUES ('2024-01-16', 1, '2024-01-16'), ('2024-02-01', 2, '9999')) d(snapshot_date, batch, until)
    ON e.snapshot_date = '2024-02-01' AND e.ts < d.until)
"""
ORACLE["incremental_ledger"] = exported_sql(DELIVERED + """
SELECT DISTINCT username, snapshot_date, basename, CAST(batch AS BIGINT) AS batch FROM files""")
ORACLE["incremental_three_runs"] = exported_sql(DELIVERED + """
SELECT username, count(DISTINCT snapshot_date || basename) AS n_files, CAST(max(batch) AS BIGINT) AS last_batch,
       count(DISTINCT ts) AS n_plays, CAST(max(strptime(ts, '%Y-%m-%dT%H:%M:%SZ')) AS TIMESTAMP) AS max_ts
FROM files GROUP BY username""")
WATERMARKS = """
, wm AS (
  SELECT 'user-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS username, max(date_trunc('second', ts)) AS max_ts
  FROM events WHERE ts < TIMESTAMP '2024-01-15' AND user_id % 10 <> 3 GROUP BY user_id
),
fresh AS (
  SELECT t.* FROM typed t LEFT JOIN wm ON wm.username = t.username
  WHERE t.ts > coalesce(wm.max_ts, TIMESTAMP '1970-01-01 00:00:00')
),
loaded AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY username, ts ORDER BY snapshot_date) AS rn FROM fresh)
  WHERE rn = 1
)"""
ORACLE["incremental_watermark_load"] = plays_sql(WATERMARKS + "\nSELECT * FROM loaded")
ORACLE["incremental_new_watermarks"] = plays_sql(WATERMARKS + """
, newmax AS (SELECT username, max(ts) AS new_ts FROM loaded GROUP BY username)
SELECT coalesce(w.username, n.username) AS username, greatest(w.max_ts, n.new_ts) AS max_ts
FROM wm w FULL OUTER JOIN newmax n ON n.username = w.username""")


# -- compatibility flags (any non-empty text is True) -------------------------

TYPED_COMPAT = TYPED.replace("typed AS (", "typed AS (", 1)
for _c in ("shuffle", "skipped", "offline", "incognito_mode"):
    TYPED_COMPAT = TYPED_COMPAT.replace(
        f"TRY_CAST({_c} AS BOOLEAN) AS {_c}", f"({_c} IS NOT NULL AND {_c} <> '') AS {_c}")
ORACLE["silver_streams_compat"] = with_ctes(RAW_PLAYS, TYPED_COMPAT, KEYED, SILVER) + "\nSELECT * FROM silver"

ORACLE["missing_weather_complete"] = with_ctes(*WX_CTES) + """
, expected AS (
  SELECT year, CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 366 ELSE 365 END AS days
  FROM (SELECT DISTINCT year FROM wreq)
),
complete_keys AS (
  SELECT d.year, d.latitude, d.longitude FROM wdaily d JOIN expected e ON e.year = d.year
  WHERE d.longitude > -60 GROUP BY d.year, d.latitude, d.longitude, e.days HAVING count(*) >= e.days
  INTERSECT
  SELECT h.year, h.latitude, h.longitude FROM whourly h JOIN expected e ON e.year = h.year
  WHERE h.longitude < 60 GROUP BY h.year, h.latitude, h.longitude, e.days HAVING count(*) >= e.days * 24
)
SELECT r.year, r.airport_code, r.latitude, r.longitude FROM wreq r
WHERE NOT EXISTS (SELECT 1 FROM complete_keys p WHERE p.year = r.year AND p.latitude = r.latitude AND p.longitude = r.longitude)"""

ORACLE["dedup_sql"] = plays_sql("""
, least AS (SELECT stream_id, min(snapshot_date) AS snapshot_date FROM keyed GROUP BY stream_id)
SELECT DISTINCT CAST(1 AS INTEGER) AS rn_by_stream_id, k.* FROM keyed k JOIN least USING (stream_id, snapshot_date)""")

ORACLE["incremental_silver_merge"] = silver_sql("""
SELECT * REPLACE (
  CASE WHEN substr(stream_id, 1, 1) IN ('0', '1') THEN NULL ELSE username END AS username,
  CASE WHEN substr(stream_id, 1, 1) IN ('1', '2') THEN NULL ELSE streamed_year END AS streamed_year) FROM silver""")

# the same chain over plays under the exporter's user names
ORACLE["stream_silver_increments"] = with_ctes(
    RAW_PLAYS.replace("raw_plays AS (", "all_plays AS ("), "raw_plays AS (SELECT * EXCLUDE (file_name) FROM exported)"
).replace("raw_plays AS (SELECT", EXPORTED.split("documents_of AS")[0].strip().strip(",").replace("FROM raw_plays)", "FROM all_plays)") + ", raw_plays AS (SELECT") \
    + "," + ",".join([TYPED, KEYED, SILVER]) + "\nSELECT * FROM silver"

# -- casts ---------------------------------------------------------------------

DIRTY = """
, dirty AS (
  SELECT * REPLACE (
    CASE split_part(ip_addr, '.', 4) WHEN '13' THEN '12x' WHEN '6' THEN 'None' ELSE ms_played END AS ms_played,
    CASE split_part(ip_addr, '.', 4) WHEN '77' THEN 'not a time' ELSE ts END AS ts,
    CASE split_part(ip_addr, '.', 4) WHEN '99' THEN 'maybe' ELSE shuffle END AS shuffle,
    CASE split_part(ip_addr, '.', 4) WHEN '111' THEN 'soon' WHEN '5' THEN '1e400' ELSE offline_timestamp END AS offline_timestamp)
  FROM raw_plays),
fields AS (
  SELECT username, ts AS exported_ts, snapshot_date AS exported_snapshot, unnest([
    {'c': 'ts', 't': ts, 'ok': TRY_CAST(ts AS TIMESTAMP) IS NOT NULL},
    {'c': 'ms_played', 't': ms_played, 'ok': TRY_CAST(ms_played AS BIGINT) IS NOT NULL},
    {'c': 'offline_timestamp', 't': offline_timestamp, 'ok': abs(TRY_CAST(offline_timestamp AS DOUBLE)) < 9e18},
    {'c': 'shuffle', 't': shuffle, 'ok': TRY_CAST(shuffle AS BOOLEAN) IS NOT NULL},
    {'c': 'skipped', 't': skipped, 'ok': TRY_CAST(skipped AS BOOLEAN) IS NOT NULL},
    {'c': 'offline', 't': offline, 'ok': TRY_CAST(offline AS BOOLEAN) IS NOT NULL},
    {'c': 'incognito_mode', 't': incognito_mode, 'ok': TRY_CAST(incognito_mode AS BOOLEAN) IS NOT NULL},
    {'c': 'snapshot_date', 't': snapshot_date, 'ok': TRY_CAST(snapshot_date AS TIMESTAMP) IS NOT NULL}]) AS f
  FROM dirty),
judged AS (
  SELECT username, exported_ts, exported_snapshot, f.c AS column_name, f.t AS text,
         f.t IS NULL OR f.t IN ('', 'None', 'nan') AS missing, coalesce(f.ok, false) AS ok FROM fields)
"""
ORACLE["cast_counts"] = plays_sql(DIRTY + """
SELECT column_name, count(*) AS n_rows, count(*) FILTER (WHERE missing) AS n_missing,
       count(*) FILTER (WHERE NOT missing AND NOT ok) AS n_failed FROM judged GROUP BY column_name""")
ORACLE["cast_rejects"] = plays_sql(DIRTY + """
SELECT username, exported_ts, exported_snapshot, column_name, text FROM judged WHERE NOT missing AND NOT ok""")

ORACLE["duplicate_profile"] = plays_sql("""
, dup AS (
  SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date)
  FROM keyed WHERE stream_id IN (SELECT stream_id FROM keyed GROUP BY stream_id HAVING count(*) > 1)),
pairs AS (""" + _union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM dup WHERE {c} IS NOT NULL" for c in RAW_COLS]) + """),
vc AS (SELECT column_name, value, count(*) AS cnt FROM pairs GROUP BY column_name, value)
SELECT column_name, CAST(sum(cnt) AS BIGINT) AS count, count(*) AS unique,
       first(value ORDER BY cnt DESC, value) AS top, max(cnt) AS freq FROM vc GROUP BY column_name""")
