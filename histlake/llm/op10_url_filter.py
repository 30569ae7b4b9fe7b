"""URL filter: rules first, then a sorted array of 64-bit digests.

The block list (hosts, or host + path) is turned once into an index: the
entries' 64-bit xxhash keys in ascending order, and the entries themselves in
the same order.  Executors map the index into memory and probe it for a whole
batch of urls by vectorised binary search; a hit counts only if the stored
string equals the probe, so collisions cannot block anything.

A url is probed with its host, every parent domain of the host, and each of
these followed by the url's path.  The index is one broadcast value while
the list stays within ``MAX_ENTRIES``; a longer list is joined by Spark on
the same digests and strings, with the same answers.

Null url, or one without "://": host and path are empty, nothing matches and
the verdict is allow.  Null and repeated entries of the list are ignored;
repeated pages each get their row, an empty table none.  Where two rules of one
length fit, the longer host wins.  Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import mmap
import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import prepare

SEED = 42                    # fixed value: the seed of Spark's xxhash64
MAX_ENTRIES = 2_000_000
#: Rules (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# Words that mark a host name as junk.
JUNK_WORDS = ("adult", "ads", "bets", "casino", "escort", "gambling", "loans", "lottery", "pills", "poker", "porn", "replica", "spam",
              "viagra", "xxx")
#: From the first label with such a word to the end of the host.
JUNK_HOST = r"(?:^|[.])((?:[^.]*-)?(?:" + "|".join(JUNK_WORDS) + r")(?:-[^.]*)?[.].*)$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    part = lambda i: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i)
    return pages.select("page_id", "url", F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))


def junk_hosts(pages: DataFrame) -> DataFrame:
    """The block list of a crawl, column ``entry``: the domains of its hosts
    that carry a junk word.  It grows with the hosts of the table."""
    entry = F.regexp_extract("host", JUNK_HOST, 1)
    return host_and_path(pages).select(entry.alias("entry")).where(F.col("entry") != "").distinct()


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds the longest fitting rule and its verdict (null where none fits)."""
    best = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    rule = verdict = None
    for v, h, p in best:
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    nothing = F.lit(None).cast("string")
    return urls.withColumn("rule", nothing if rule is None else rule).withColumn(
        "rule_verdict", nothing if verdict is None else verdict)


def probes(host: str, path: str) -> list[str]:
    """Strings that block a url if the list holds one of them."""
    parts = host.split(".")
    names = [".".join(parts[i:]) for i in range(len(parts))] if host else []
    return [x for n in names for x in ((n, n + path) if path else (n,))]


class DigestArray:
    """Sorted digests with their strings, over one read-only memory map."""

    def __init__(self, data: bytes):
        fd = os.memfd_create("digests")
        os.write(fd, data) if len(data) < 1 << 30 else [os.write(fd, data[i:i + (1 << 30)]) for i in range(0, len(data), 1 << 30)]
        self.map = mmap.mmap(fd, 0, prot=mmap.PROT_READ)
        os.close(fd)
        n = int(np.frombuffer(self.map, np.int64, 1)[0])
        self.keys = np.frombuffer(self.map, np.uint64, n, 8)
        self.ends = np.frombuffer(self.map, np.int64, n + 1, 8 + 8 * n)
        self.base = 16 + 16 * n

    @staticmethod
    def pack(entries: list[bytes]) -> bytes:
        keyed = sorted((xxhash.xxh64_intdigest(e, SEED), e) for e in set(entries))
        ends = np.cumsum([0, *(len(e) for _, e in keyed)], dtype=np.int64)
        return b"".join([np.int64(len(keyed)).tobytes(), np.array([k for k, _ in keyed], np.uint64).tobytes(),
                         ends.tobytes(), *(e for _, e in keyed)])

    def entry(self, i: int) -> bytes:
        return self.map[self.base + int(self.ends[i]):self.base + int(self.ends[i + 1])]

    def contains(self, strings: list[bytes], digests: np.ndarray | None = None) -> np.ndarray:
        if digests is None:
            digests = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in strings), np.uint64, len(strings))
        found = np.zeros(len(strings), bool)
        if not len(self.keys):
            return found
        low = np.searchsorted(self.keys, digests, "left")
        high = np.searchsorted(self.keys, digests, "right")
        for i in np.flatnonzero(low < high):
            found[i] = any(self.entry(k) == strings[i] for k in range(low[i], high[i]))
        return found


_OPEN: dict[str, DigestArray] = {}


def _mapped(data: bytes) -> DigestArray:
    key = xxhash.xxh3_128_hexdigest(data)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = DigestArray(data)
    return _OPEN[key]


def _by_array(urls: DataFrame, entries: list[str]) -> DataFrame:
    index = urls.sparkSession.sparkContext.broadcast(DigestArray.pack([e.encode() for e in entries]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)

    def run(batches):
        array = _mapped(index.value)
        for b in batches:
            tried = [probes(h, p) for h, p in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)]
            owner = np.repeat(np.arange(len(tried)), [len(x) for x in tried])
            hit = array.contains([s.encode() for x in tried for s in x])
            blocked = np.bincount(owner[hit], minlength=len(tried)) > 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(blocked)], names=[*b.schema.names, "listed"])

    return urls.mapInArrow(run, f"{schema}, listed boolean")


def _by_join(urls: DataFrame, blocked: DataFrame) -> DataFrame:
    """The same answers by a join on digest and string, for lists of any length."""
    parts = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    names = F.when(F.col("host") != "", names).otherwise(F.array().cast("array<string>"))
    tried = F.array_union(names, F.transform(names, lambda n: F.concat(n, F.col("path"))))
    strings = urls.select("host", "path").distinct().select("host", "path", F.explode(tried).alias("probe"))
    entries = blocked.select(F.xxhash64("entry").alias("key"), "entry").distinct()
    hits = strings.withColumn("probe_key", F.xxhash64("probe")).join(
        entries, (F.col("probe_key") == F.col("key")) & (F.col("probe") == F.col("entry")), "left_semi")
    hits = hits.select("host", "path").distinct().withColumn("listed", F.lit(True))
    return urls.join(hits, ["host", "path"], "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def judge_urls(pages: DataFrame, blocked: DataFrame, rules=RULES, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``blocked`` has
    the column ``entry``."""
    prepare(pages.sparkSession)
    urls = with_rule(host_and_path(pages), rules).drop("url")
    entries = blocked.select("entry").where(F.col("entry").isNotNull() & (F.col("entry") != "")).distinct()
    some = [r[0] for r in entries.limit(max_entries + 1).collect()]
    found = _by_array(urls, some) if len(some) <= max_entries else _by_join(urls, entries)
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


ORACLE = """
WITH u AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's') AS raw_host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
h AS (SELECT page_id, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM u),
rules(verdict, rhost, rpath) AS (VALUES """ + ", ".join(str(r) for r in RULES) + """),
hit AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS rn
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
listed AS (SELECT DISTINCT regexp_extract(host, '""" + JUNK_HOST + """', 1) AS entry FROM h
           WHERE regexp_extract(host, '""" + JUNK_HOST + """', 1) <> '')
SELECT h.page_id, h.host, h.path, hit.rule,
       coalesce(hit.verdict, CASE WHEN EXISTS (
         SELECT 1 FROM listed WHERE h.host = entry OR ends_with(h.host, '.' || entry)
           OR h.host || h.path = entry OR ends_with(h.host || h.path, '.' || entry) AND contains(entry, '/'))
         THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN hit ON h.page_id = hit.page_id AND h.host = hit.host AND h.path = hit.path AND hit.rn = 1
"""
