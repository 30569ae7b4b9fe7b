"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from histlake.llm import op5_line_dedup, op6_substring_dedup

WHITE = r"[ \t\n\v\f\r]"

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, i AS line_no, parts[i] AS line, regexp_replace(parts[i], '^{WHITE}+|{WHITE}+$', '', 'g') AS norm
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d, range(1, len(parts) + 1) r(i)),
worded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS nth FROM lines WHERE norm <> ''),
grams AS (
  SELECT doc_id, nth, list(norm) OVER w AS gram FROM worded
  WINDOW w AS (PARTITION BY doc_id ORDER BY nth ROWS BETWEEN CURRENT ROW AND {op5_line_dedup.WINDOW - 1} FOLLOWING)),
ranked AS (
  SELECT doc_id, nth, row_number() OVER (PARTITION BY gram ORDER BY doc_id, nth) AS rn
  FROM grams WHERE len(gram) = {op5_line_dedup.WINDOW}),
gone AS (SELECT DISTINCT doc_id, nth + o AS nth FROM ranked, range({op5_line_dedup.WINDOW}) k(o) WHERE rn > 1),
starts AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (step IS NULL OR step > 1) AS n_runs
  FROM (SELECT doc_id, nth - lag(nth) OVER (PARTITION BY doc_id ORDER BY nth) AS step FROM gone) GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, count(w.nth) AS n_lines, count(w.nth) FILTER (g.nth IS NULL) AS n_left,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.nth IS NULL), '') AS text
  FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.line_no = w.line_no
  LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.nth = g.nth GROUP BY l.doc_id)
SELECT k.doc_id, k.n_lines, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_runs, 0) AS n_runs,
       sha256(CASE WHEN n_left = 0 AND coalesce(s.n_removed, 0) > 0 THEN '' ELSE k.text END) AS kept_sha256
FROM kept k LEFT JOIN starts s ON k.doc_id = s.doc_id
"""

LINE_PASSAGES = rf"""
WITH lines AS (
  SELECT doc_id, i AS line_no, parts[i] AS line, regexp_replace(parts[i], '^{WHITE}+|{WHITE}+$', '', 'g') AS norm
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d, range(1, len(parts) + 1) r(i)),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS nth,
         len(regexp_split_to_array(norm, '{WHITE}+')) AS n_words FROM lines WHERE norm <> ''),
grams AS (
  SELECT doc_id, nth, list(norm) OVER w AS gram, list(n_words) OVER w AS counts FROM worded
  WINDOW w AS (PARTITION BY doc_id ORDER BY nth ROWS BETWEEN CURRENT ROW AND {op5_line_dedup.WINDOW - 1} FOLLOWING)),
ranked AS (
  SELECT doc_id, nth, size, row_number() OVER (PARTITION BY gram[1:size] ORDER BY doc_id, nth) AS rn
  FROM grams, range(1, {op5_line_dedup.WINDOW + 1}) s(size)
  WHERE size <= len(gram) AND (size = {op5_line_dedup.WINDOW} OR list_sum(counts[1:size]) >= {op5_line_dedup.MIN_WORDS})),
gone AS (SELECT DISTINCT doc_id, nth + o AS nth FROM ranked, range({op5_line_dedup.WINDOW}) k(o) WHERE rn > 1 AND o < size),
starts AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (step IS NULL OR step > 1) AS n_runs
  FROM (SELECT doc_id, nth - lag(nth) OVER (PARTITION BY doc_id ORDER BY nth) AS step FROM gone) GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, count(w.nth) AS n_lines, count(w.nth) FILTER (g.nth IS NULL) AS n_left,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (g.nth IS NULL), '') AS text
  FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.line_no = w.line_no
  LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.nth = g.nth GROUP BY l.doc_id)
SELECT k.doc_id, k.n_lines, coalesce(s.n_removed, 0) AS n_removed, coalesce(s.n_runs, 0) AS n_runs,
       sha256(CASE WHEN n_left = 0 AND coalesce(s.n_removed, 0) > 0 THEN '' ELSE k.text END) AS kept_sha256
FROM kept k LEFT JOIN starts s ON k.doc_id = s.doc_id
"""

SUBSTRING_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, i AS line_no, parts[i] AS line, strlen(parts[i]) AS bytes
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d, range(1, len(parts) + 1) r(i)),
placed AS (
  SELECT doc_id, line, sum(bytes + 1) OVER (PARTITION BY doc_id ORDER BY line_no) - bytes - 1 AS start, bytes,
         regexp_extract_all(line, '[^.!?]*[.!?]+|[^.!?]+') AS pieces FROM lines),
cut AS (
  SELECT doc_id, start AS line_start, j, pieces[j] AS unit, strlen(pieces[j]) AS bytes
  FROM placed, range(1, len(pieces) + 1) r(j)
  WHERE len(list_filter(pieces, lambda p: regexp_replace(p, '{WHITE}+', '', 'g') <> '')) > 1),
units AS (
  SELECT doc_id, CAST(start AS BIGINT) AS a, CAST(start + bytes AS BIGINT) AS b, line AS unit FROM placed
  UNION ALL
  SELECT doc_id, CAST(line_start + sum(bytes) OVER w - bytes AS BIGINT), CAST(line_start + sum(bytes) OVER w AS BIGINT), unit
  FROM cut WINDOW w AS (PARTITION BY doc_id, line_start ORDER BY j)),
norm AS (
  SELECT doc_id, a, b, list_filter(regexp_split_to_array(
    translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WHITE}+'), lambda w: w <> '') AS words FROM units),
ranked AS (
  SELECT doc_id, a, b, row_number() OVER (PARTITION BY words ORDER BY doc_id, a, b DESC) AS rn
  FROM norm WHERE len(words) >= {op6_substring_dedup.MIN_WORDS}),
counts AS (SELECT doc_id, count(*) AS n_units, count(*) FILTER (rn > 1) AS n_removed FROM ranked GROUP BY doc_id),
marked AS (
  SELECT doc_id, a, b, max(b) OVER (PARTITION BY doc_id ORDER BY a, b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM ranked WHERE rn > 1),
runs AS (SELECT doc_id, a, b, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY a, b DESC ROWS UNBOUNDED PRECEDING) AS run FROM marked),
spans AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM runs GROUP BY doc_id, run),
removed AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed,
                   list({{'a': a, 'b': b}} ORDER BY a) AS list FROM spans GROUP BY doc_id),
bytes AS (
  SELECT d.doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, coalesce(removed, '') AS removed,
         encode(coalesce(text, '')) AS raw, coalesce(list, []) AS list
  FROM documents d LEFT JOIN removed r ON d.doc_id = r.doc_id),
kept AS (
  SELECT doc_id, n_bytes, removed, list_reduce(
    list_transform(range(0, len(list) + 1), lambda i:
      raw[(CASE WHEN i = 0 THEN 0 ELSE list[i].b END) + 1 : (CASE WHEN i = len(list) THEN n_bytes ELSE list[i + 1].a END)]),
    lambda x, y: x || y) AS raw FROM bytes)
SELECT k.doc_id, k.n_bytes, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, removed, sha256(raw) AS kept_sha256
FROM kept k LEFT JOIN counts c ON k.doc_id = c.doc_id
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WHITE}+'), lambda w: w <> '') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM words, range(1, greatest(len(w) - 4, least(len(w), 1)) + 1) r(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * shared >= 75 * (s.n + t.n - shared)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

#: Every 50-byte string with the smallest document that it starts in; texts as
#: hex digits, cut into short pieces first (DuckDB walks a text to a position).
STRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
pieces AS (
  SELECT doc_id, c, substr(h, 2 * c + 1, 2 * 305) AS piece, least(256, n - 49 - c) AS m
  FROM (SELECT doc_id, h, n, unnest(range(0, n - 49, 256)) AS c FROM texts WHERE n >= 50)),
strings AS (
  SELECT doc_id, c + i AS i, substr(piece, 2 * i + 1, 100) AS string FROM (SELECT doc_id, c, piece, unnest(range(m)) AS i FROM pieces)),
firsts AS (SELECT string, min(doc_id) AS first FROM strings GROUP BY string HAVING count(DISTINCT doc_id) > 1),
hits AS (SELECT DISTINCT s.doc_id, s.i FROM strings s JOIN firsts f USING (string) WHERE f.first < s.doc_id),
steps AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS opens FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
kept AS (
  SELECT t.doc_id, t.n, count(g.a) AS n_spans, coalesce(sum(g.b - g.a), 0) AS n_removed,
         coalesce(string_agg(substr(t.h, 2 * g.before + 1, 2 * (g.a - g.before)), '' ORDER BY g.a), '')
           || substr(any_value(t.h), 2 * coalesce(max(g.b), 0) + 1) AS rest
  FROM texts t LEFT JOIN gaps g USING (doc_id) GROUP BY t.doc_id, t.n)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256 FROM kept
"""
