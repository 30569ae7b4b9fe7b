"""Main text of html pages by site style trees.

The pages of one host are merged into one tree: a node is the path of labels
(tag, role, class and id words) from body down.  Over the pages that have a
node, two entropies (base: their number m) tell how much it varies:

* presentation: of the runs of child labels that the node shows,
* content: 1 - the mean over its distinct texts of log_m(pages with the text).

The importance of a node is the larger of the two, drawn towards 1 while few
pages have it (``PRIOR`` pages' worth).  The same is done for all hosts
merged, for sites with few pages, and the lower value counts.  From each page
go the branches of little importance: those whose every text lies in a node
below ``THRESHOLD``.

What labels say stands beside the numbers: menus, footers, adverts, forms
and the like, comments and what is not shown go by tag or class word however
much they vary.  Inside ``article`` and ``main`` a node without such a word
goes only below ``INNER`` and if more than half of the host's pages have it,
so copies of an article do not make it boilerplate; if text is left there,
text outside it goes.  A page that would lose all its text this way keeps
what no tag or word rejects.

Texts: character references decoded, white space inside a block one space,
blocks in page order on a line each.  ``br`` is white space.  A null or empty
page, or one without text, gives the empty text.  A null url or one without
"://" belongs to the host ''.  Repeated pages and page_ids each give a row,
an empty table none; other columns are ignored, whatever their names.

The trees are counted by Spark: tasks emit (host, node, text) digests once
per page, no page travels, and only the keys of unimportant nodes are sent
back to the tasks, ``MAX_KEYS`` at most per pass over the pages (more keys:
more passes, by host).  Digests have 64 bits.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import prepare, saved, slices
from histlake.llm.page_tree import Chunk, read_page

THRESHOLD = 0.8
INNER = 0.3
PRIOR = 10
MAX_KEYS = 1_000_000         # 9 MB a pass
CONTENT, SHAPE, PRESENCE = 0, 1, 2

# Tags and label words of what is not the article.
NOT_TEXT = frozenset("head nav footer aside form menu dialog button select fieldset template noscript svg math object canvas "
                     "audio video map".split())
NOT_ARTICLE = frozenset(
    "ad ads adsense alert alerts banner banners popup modal overlay dialog toast notice notices notification notifications "
    "consent gdpr paywall nav navigation menu menus masthead topbar toolbar aside complementary rail widget widgets related "
    "recommended recommendations trending popular share sharing social signup login search form disqus reply replies respond "
    "pagination pager copyright contentinfo skip teaser teasers".split())
#: Beginnings of such words.
NOT_ARTICLE_STEMS = ("advert", "breadcrumb", "commentlist", "comments", "cookie", "footer", "navbar", "newsletter", "promo", "sidebar",
                     "sponsor", "subscri")
#: These words only count outside of articles.
PAGE_PARTS = frozenset("header".split())
ROOTS = frozenset("article main".split())
ROOT_WORDS = frozenset("article main content post entry story body text".split())


@functools.lru_cache(4096)
def _kind(label: str) -> str:
    """``out``: not the article; ``root``: an article; ``part``: out unless
    inside an article; else empty."""
    tag, *words = label.split(".")
    if tag.startswith("!") or tag in NOT_TEXT or not NOT_ARTICLE.isdisjoint(words):
        return "out"
    if any(w == "comment" or w.startswith(NOT_ARTICLE_STEMS) for w in words):
        return "out"
    if tag in ROOTS or not ROOTS.isdisjoint(words) and ROOT_WORDS.issuperset(words):
        return "root"
    if tag in PAGE_PARTS or not PAGE_PARTS.isdisjoint(words):
        return "part"
    return ""


def by_label(path: str) -> tuple[bool, bool]:
    """Whether a path's labels reject it, and whether it is in an article."""
    inside = False
    for label in path.split("/"):
        kind = _kind(label)
        if kind == "out" or kind == "part" and not inside:
            return True, inside
        inside = inside or kind == "root"
    return False, inside


def tidy(text: str) -> str:
    return " ".join(text.split())


def _digest(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "replace")) - (1 << 63)


def node_key(host: str, path: str) -> int:
    return _digest(host, path)


# -- the trees -----------------------------------------------------------------

def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def texts_by_node(chunks: list[Chunk]) -> dict[str, set[str]]:
    """Per path, the texts that it holds, block by block."""
    joined: dict[tuple[str, int], list[str]] = {}
    for c in chunks:
        joined.setdefault((c.path, c.block), []).append(c.text)
    out: dict[str, set[str]] = {}
    for (path, _), parts in joined.items():
        text = tidy("".join(parts))
        if text:
            out.setdefault(path, set()).add(text)
    return out


def observations(pages: DataFrame) -> DataFrame:
    """host, node, kind, feature: each feature once per page and node."""
    def run(batches):
        for b in slices(batches, 500):
            rows: list[tuple] = []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                chunks, shapes = read_page(page or "")
                for path, found in shapes.items():
                    node = _digest(path)
                    rows.append((host, node, PRESENCE, 0))
                    rows += [(host, node, SHAPE, _digest(s)) for s in found]
                for path, found in texts_by_node(chunks).items():
                    rows += [(host, _digest(path), CONTENT, _digest(t)) for t in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int64()))],
                names=["host", "node", "kind", "feature"])

    return pages.select(_host().alias("host"), "html").mapInArrow(run, "host string, node long, kind int, feature long")


def _importance(counts: DataFrame, by: list[str]) -> DataFrame:
    """``by``, pages, importance from the pages ``c`` that have each feature."""
    of = lambda kind, c: F.when(F.col("kind") == kind, c)
    c = F.col("c")
    sums = counts.groupBy(*by).agg(
        F.max(of(PRESENCE, c)).alias("pages"), F.sum(of(CONTENT, F.log(c))).alias("logs"), F.count(of(CONTENT, c)).alias("texts"),
        F.sum(of(SHAPE, c)).alias("shown"), F.sum(of(SHAPE, c * F.log(c))).alias("shapes"))
    base = F.log("pages")
    content = F.when(F.col("texts") > 0, 1 - F.col("logs") / F.col("texts") / base)
    shape = (F.log("shown") - F.col("shapes") / F.col("shown")) / base
    value = F.when(F.col("pages") <= 1, F.lit(1.0)).otherwise(F.greatest(F.coalesce(content, F.lit(0.0)), shape))
    return sums.select(*by, "pages", ((F.col("pages") * value + PRIOR) / (F.col("pages") + PRIOR)).alias("importance"),
                       (F.col("texts") > 0).alias("holds_text"))


def site_trees(pages: DataFrame) -> DataFrame:
    """host, node, share (of the host's pages that have the node) and
    importance (the lower of the host's and that over all hosts), for the
    nodes that hold text."""
    prepare(pages.sparkSession)
    counts = saved(observations(pages).groupBy("host", "node", "kind", "feature").agg(F.count(F.lit(1)).alias("c")), "site-trees")
    own = _importance(counts, ["host", "node"])
    merged = counts.groupBy("node", "kind", "feature").agg(F.sum("c").alias("c"))
    everywhere = _importance(merged, ["node"]).select("node", F.col("importance").alias("general"))
    total = own.groupBy("host").agg(F.max("pages").alias("total"))      # the root is on every page
    return own.where("holds_text").join(everywhere, "node").join(total, "host").select(
        "host", "node", (F.col("pages") / F.col("total")).alias("share"), F.least("importance", "general").alias("importance"))


# -- the pages -------------------------------------------------------------------

def main_text(page: str, low: frozenset | set = frozenset(), lowest: frozenset | set = frozenset(), node=lambda path: path) -> str:
    """The text of one page; ``low`` and ``lowest`` hold unimportant nodes
    (outside and inside of articles) as ``node`` names them."""
    chunks, _ = read_page(page)
    verdict: dict[str, tuple[bool, bool, bool]] = {}
    for path in {c.path for c in chunks}:
        rejected, inside = by_label(path)
        name = node(path) if not rejected else None
        verdict[path] = (rejected, inside, name in (lowest if inside else low))
    left = [c for c in chunks if not verdict[c.path][0]]
    kept = [c for c in left if not verdict[c.path][2]]
    if not any(not c.text.isspace() for c in kept):
        kept = left
    if any(verdict[c.path][1] and not c.text.isspace() for c in kept):
        kept = [c for c in kept if verdict[c.path][1]]
    blocks: dict[int, list[str]] = {}
    for c in kept:
        blocks.setdefault(c.block, []).append(c.text)
    return "\n".join(t for t in (tidy("".join(parts)) for parts in blocks.values()) if t)


class _Nodes:
    """Membership of host nodes in a sorted array of keys."""

    def __init__(self, keys: np.ndarray, host: str):
        self.keys, self.host = keys, host

    def __contains__(self, path: str | None) -> bool:
        if path is None or not len(self.keys):
            return False
        key = node_key(self.host, str(_digest(path)))
        at = int(np.searchsorted(self.keys, key))
        return at < len(self.keys) and int(self.keys[at]) == key


def _extract(pages: DataFrame, low: np.ndarray, lowest: np.ndarray) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast((low, lowest))

    def run(batches):
        low, lowest = shared.value
        for b in slices(batches, 500):
            texts = [main_text(page or "", _Nodes(low, host), _Nodes(lowest, host))
                     for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extract_main_text(pages: DataFrame, max_keys: int = MAX_KEYS) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = prepare(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", _host().alias("host"))
    trees = site_trees(pages)
    low = saved(trees.where(F.col("importance") < THRESHOLD).select(
        "host", "node", ((F.col("importance") < INNER) & (F.col("share") > 0.5)).alias("lowest")), "low-nodes")
    passes = max(1, -(-low.count() // max_keys))
    shard = F.pmod(F.xxhash64("host"), F.lit(passes))
    parts = []
    for i in range(passes):
        rows = low.where(shard == i).collect()
        keys = np.array([node_key(r["host"], str(r["node"])) for r in rows], np.int64)
        inner = np.array([r["lowest"] for r in rows], bool)
        part = _extract(pages.where(shard == i) if passes > 1 else pages, np.sort(keys), np.sort(keys[inner]))
        parts.append(part if passes == 1 else saved(part, "main-text"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The pages of the tables have one template, which plain SQL can take apart.
ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
b AS (
  SELECT page_id, url, list_transform(
    string_split(regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '</?(p|h1)>', chr(1), 'g'), chr(1)),
    lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(x, '<br>', ' '), '&quot;', '"'), '&lt;', '<'),
      '&gt;', '>'), '&#x27;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks FROM a),
c AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x: regexp_replace(x, '&amp$', '&')),
    lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM c
"""
