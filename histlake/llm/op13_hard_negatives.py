"""Hard negatives by rotated one-bit codes.

Each vector v (whole numbers, floor(256 * x)) is turned by a fixed random
rotation and stored as the signs of its coordinates, its length and its
alignment a = <v / |v|, s>, where s is the unit vector of the signs.  An
anchor q is turned the same way and its coordinates are rounded to ``BITS``
bit planes, so t = <q / |q|, s> comes from popcounts of code and planes, up
to the known rounding of the anchor.  What is left of v and q beside s is at
most sqrt(1 - a^2) and sqrt(1 - t^2) long, so by Cauchy and Schwarz

    <v, q> / |v||q|  lies in  a t  +-  sqrt((1 - a^2)(1 - t^2)).

Only rows whose interval meets the wanted scores get their exact integer
product.  Positives: the first 5 rows of the anchor's label, the interval's
upper end against the running fifth score.  Negatives: rows of other labels
whose interval meets [0.8 p, p] for a positive score p.

The code table is stored once and never shuffled: anchors travel in blocks
of bounded size as a broadcast, every task keeps the best few per anchor,
and these are merged by key.

Rows without vec_id, with a null label, a null vector or a null or
non-finite component take no part.  Rows that share the anchor's vec_id are
its own, neither positive nor negative; equal anchor rows give one result,
and an id with several vectors or labels is an anchor for each.  Repeated
rows count each as candidates.  Vectors of another length than the anchor's
are no candidates.  Ties go to the smaller vec_id.  Scores are compared
exactly (Python numbers where a double cannot hold them); one beyond the
range of a long counts as its nearest end.  An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histlake.llm.common import prepare, saved
from histlake.llm.vectors import finite, matrices

BITS = 8
BLOCK = 8192                 # rows compared at a time
ANCHOR_BYTES = 8 << 20       # of anchors in one broadcast
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100          # LOW * positive <= 100 * negative <= HIGH * positive
EDGE = (1 << 63) - 1
CODES = "vec_id long, label long, v array<double>, size double, align double, code binary"


def whole_vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, label and v of the rows that take part; whole numbers up to
    any size are kept as doubles, which hold floor(256 * x) exactly."""
    x = F.transform(column, lambda c: 256 * c.cast("double"))
    # floor() gives a long: beyond 2^52 a double is whole already
    v = F.transform(x, lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c))
    fits = F.forall(x, lambda c: F.abs(c) < float("inf"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(column)).where(fits).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))


# -- codes ---------------------------------------------------------------------

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix for vectors of this length."""
    if dim not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
        _ROTATIONS[dim] = q * np.sign(np.diagonal(r))[None, :]
    return _ROTATIONS[dim]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    packed = np.packbits(bits, axis=1)
    width = -(-max(1, packed.shape[1]) // 8) * 8
    return np.pad(packed, ((0, 0), (0, width - packed.shape[1]))).view(np.uint64)


def turned(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and the rotated unit vectors (zero vectors stay zero)."""
    top = np.abs(v).max(1, initial=0)
    top = np.where(top > 0, top, 1)
    scaled = v / top[:, None]           # squares of large components would overflow
    norm = np.sqrt((scaled * scaled).sum(1))
    unit = scaled / np.where(norm > 0, norm, 1)[:, None]
    return norm * top, unit @ rotation(v.shape[1])


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, alignments and code words of whole vectors."""
    size, unit = turned(v)
    align = np.abs(unit).sum(1) / np.sqrt(max(1, v.shape[1]))
    return size, align, _words(unit > 0)


def code_table(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            ids, labels, vectors = b.column("vec_id"), b.column("label"), b.column("v")
            for at, v in matrices(vectors):
                size, align, code = encode(v)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), labels.take(take), vectors.take(take), pa.array(size), pa.array(align),
                     pa.array([c.tobytes() for c in code], pa.binary())],
                    names=["vec_id", "label", "v", "size", "align", "code"])

    return rows.mapInArrow(run, CODES)


def _long(x: int) -> int:
    return max(-EDGE, min(EDGE, x))


class Anchor:
    """One anchor with its rotated coordinates as bit planes."""

    def __init__(self, key: int, vec_id: int, label: int, v: np.ndarray, scores: tuple[int, ...] = ()):
        self.key, self.vec_id, self.label, self.v, self.scores = key, vec_id, label, v, scores
        size, unit = turned(v[None, :])
        self.size, unit = float(size[0]), unit[0]
        self.base = float(unit.min(initial=0))
        self.step = max(float(unit.max(initial=0)) - self.base, 1e-30) / ((1 << BITS) - 1)
        level = np.rint((unit - self.base) / self.step).astype(np.int64)
        self.rounding = float(np.linalg.norm(unit - (self.base + self.step * level)))
        self.planes = _words(np.array([(level >> j) & 1 for j in range(BITS)], bool).reshape(BITS, -1))
        self.total = float((self.base + self.step * level).sum())
        self.top = float(np.abs(v).max(initial=0))

    def interval(self, size: np.ndarray, align: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of coded rows."""
        dim = max(1, len(self.v))
        ones = np.bitwise_count(code).sum(1).astype(float)
        weighted = np.zeros(len(code))
        for j in range(BITS):
            weighted += np.bitwise_count(code & self.planes[j]).sum(1) * float(1 << j)
        t = (2 * (self.base * ones + self.step * weighted) - self.total) / np.sqrt(dim)
        least = np.maximum(0.0, np.abs(t) - self.rounding)
        rest = np.sqrt(np.maximum(0.0, 1 - align * align) * np.maximum(0.0, 1 - least * least))
        width = rest + align * self.rounding + 1e-9
        with np.errstate(over="ignore", invalid="ignore"):
            scale = size * self.size
            low, high = scale * (align * t - width) - 1, scale * (align * t + width) + 1
        # lengths beyond a double say nothing; scores end at the ends of a long
        end = float(EDGE)
        return (np.clip(np.where(np.isfinite(low), low, -np.inf), -end, end),
                np.clip(np.where(np.isfinite(high), high, np.inf), -end, end))

    def products(self, v: np.ndarray) -> list[int] | np.ndarray:
        """Exact scores of rows."""
        if len(self.v) * max(1.0, self.top) * max(1.0, float(np.abs(v).max(initial=0))) < 2.0 ** 52:
            return (v @ self.v).astype(np.int64)
        q = [int(x) for x in self.v]
        return [_long(sum(int(a) * b for a, b in zip(row, q, strict=True))) for row in v]


class Block:
    """Coded rows of one length."""

    def __init__(self, ids, labels, v, size, align, code):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.v, self.size, self.align = (c[order] for c in (ids, labels, v, size, align))
        self.code = np.frombuffer(b"".join(code[i] for i in order), np.uint64).reshape(len(order), -1)
        self.same = {int(x): np.flatnonzero(self.labels == x) for x in np.unique(self.labels)}
        self.others: dict[int, np.ndarray] = {}

    def of_label(self, label: int) -> np.ndarray:
        return self.same.get(label, np.zeros(0, np.int64))

    def of_others(self, label: int) -> np.ndarray:
        if label not in self.others:
            self.others[label] = np.flatnonzero(self.labels != label)
        return self.others[label]


def blocks(batches) -> dict:
    """Blocks of at most ``BLOCK`` rows, one length of vector each."""
    waiting: dict[int, list] = {}

    def joined(dim):
        parts = waiting.pop(dim)
        return dim, Block(*(np.concatenate([p[k] for p in parts]) for k in range(5)), [c for p in parts for c in p[5]])

    for b in batches:
        for start in range(0, b.num_rows, BLOCK):
            part = b.slice(start, BLOCK)
            code = part.column("code").to_pylist()
            flat = [part.column(k).to_numpy(zero_copy_only=False) for k in ("vec_id", "label", "size", "align")]
            for at, v in matrices(part.column("v")):
                ids, labels, size, align = (c[at] for c in flat)
                waiting.setdefault(v.shape[1], []).append((ids, labels, v, size, align, [code[i] for i in at]))
                if sum(len(p[0]) for p in waiting[v.shape[1]]) >= BLOCK:
                    yield joined(v.shape[1])
    for dim in list(waiting):
        yield joined(dim)


def _best(found: list, new, count: int) -> list:
    return heapq.nsmallest(count, [*found, *new])


def positives_of(anchor: Anchor, block: Block, found: list, count: int) -> list:
    """The best (-score, vec_id) so far, with this block's rows."""
    at = block.of_label(anchor.label)
    at = at[block.ids[at] != anchor.vec_id]
    if len(found) == count and len(at):
        _, high = anchor.interval(block.size[at], block.align[at], block.code[at])
        at = at[high >= -found[-1][0]]
    scores = anchor.products(block.v[at])
    return _best(found, zip((-int(s) for s in scores), block.ids[at].tolist(), strict=True), count)


def negatives_of(anchor: Anchor, block: Block, found: dict, count: int, low: int, high: int) -> dict:
    """Per positive score, the best (-score, vec_id) so far."""
    at = block.of_others(anchor.label)
    at = at[block.ids[at] != anchor.vec_id]
    wanted = {p: (-(-low * p // 100), high * p // 100) for p in anchor.scores}
    wanted = {p: w for p, w in wanted.items() if w[0] <= w[1]}
    if not wanted or not len(at):
        return found
    under, over = anchor.interval(block.size[at], block.align[at], block.code[at])
    # a full list asks for scores from its last one on
    ask = {p: max(w[0], -found[p][-1][0]) if len(found.get(p, ())) == count else w[0] for p, w in wanted.items()}
    at = at[(over >= float(min(ask.values()))) & (under <= float(max(w[1] for w in wanted.values())))]
    scores = sorted(zip((-int(s) for s in anchor.products(block.v[at])), block.ids[at].tolist(), strict=True))
    for p, (least, most) in wanted.items():
        first = bisect_left(scores, (-most, -EDGE - 1))
        fits = [x for x in scores[first:first + count] if -x[0] >= least]
        found[p] = _best(found.get(p, []), fits, count)
    return found


# -- the operator -----------------------------------------------------------------

def _anchor_blocks(anchors: DataFrame, bytes_: int):
    """The anchors in lots of bounded size, one at a time on the driver."""
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    lots = -(-size["n"] * 8 * max(1, size["d"] or 0) // bytes_)
    lot = F.pmod(F.xxhash64("key"), F.lit(max(1, lots)))
    for i in range(lots):
        yield anchors.where(lot == i).collect()


def _over_codes(codes: DataFrame, lot: list, count: int, bounds: tuple[int, int] | None) -> DataFrame:
    shared = codes.sparkSession.sparkContext.broadcast(
        [(r["key"], r["vec_id"], r["label"], r["v"], tuple(r["scores"] or ())) for r in lot])

    def run(batches):
        anchors: dict[int, list[Anchor]] = {}
        for key, vec_id, label, v, scores in shared.value:
            anchors.setdefault(len(v), []).append(Anchor(key, vec_id, label, np.array(v, float), scores))
        best: dict = {}
        for dim, block in blocks(batches):
            for a in anchors.get(dim, ()):
                if bounds is None:
                    best[a.key] = positives_of(a, block, best.get(a.key, []), count)
                else:
                    best[a.key] = negatives_of(a, block, best.get(a.key, {}), count, *bounds)
        if bounds is None:
            rows = [(key, 0, i, -s) for key, found in best.items() for s, i in found]
        else:
            rows = [(key, p, i, -s) for key, by in best.items() for p, found in by.items() for s, i in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)],
                                         names=["key", "positive_score", "vec_id", "score"])

    return codes.mapInArrow(run, "key long, positive_score long, vec_id long, score long")


def _nearest(codes: DataFrame, anchors: DataFrame, count: int, bounds, name: str, bytes_: int) -> DataFrame:
    """The first ``count`` rows per anchor (and positive score)."""
    parts = [saved(_over_codes(codes, lot, count, bounds), name) for lot in _anchor_blocks(anchors, bytes_)]
    if not parts:
        return codes.sparkSession.createDataFrame([], "key long, positive_score long, vec_id long, score long, rank int")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    w = Window.partitionBy("key", "positive_score").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= count)


def hard_negatives(rows: DataFrame, is_anchor: Column, column: str = "embedding", positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score; ``is_anchor`` is a condition on vec_id."""
    prepare(rows.sparkSession)
    codes = saved(code_table(whole_vectors(rows, column)), "one-bit-codes")
    anchors = codes.where(is_anchor).select("vec_id", "label", "v").distinct().withColumn(
        "key", F.xxhash64("vec_id", "label", "v"))
    anchors = saved(anchors, "anchors")
    none = F.lit(None).cast("array<long>")
    first = _nearest(codes, anchors.withColumn("scores", none), positives, None, "positives", anchor_bytes)
    first = saved(first.select("key", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                               F.col("rank").alias("positive_rank")), "ranked-positives")
    wanted = first.groupBy("key").agg(F.collect_set("positive_score").alias("scores"))   # one to five scores
    second = _nearest(codes, anchors.join(wanted, "key"), negatives, (low, high), "negatives", anchor_bytes)
    return (first.join(second.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}), ["key", "positive_score"])
            .join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, x.vec_id AS vec_id, a.label = x.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, x.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v a JOIN v x ON a.vec_id <> x.vec_id AND len(a.v) = len(x.v) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank FROM n WHERE rank <= 5
"""
