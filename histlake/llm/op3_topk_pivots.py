"""Exact top-k search by inner product with pivot-table elimination.

Vectors are integers, floor(256 * x).  A pivot table holds the distance of
every vector to each pivot.  For a query q and a vector x every pivot p gives
|d(q,p) - d(x,p)| <= d(q,x); the largest is a lower bound of the distance and,
since 2<q,x> = |q|^2 + |x|^2 - d(q,x)^2, an upper bound of the score.
Vectors with the same nearest pivot and similar distances to it share a shelf,
which keeps the range of its distances to each pivot.  A query scores its most
promising shelf first, then every shelf whose bound is not below its k-th best
score, so the result is exact.  A shelf is scored for its queries at once.

Queries and vectors are dealt into blocks of bounded size and every pair of
blocks is one group; the partial top-k lists are merged per query.  Pivots
are ``PIVOTS`` vectors chosen by hash, a fixed number.

Vectors that are null or hold null or non-finite components take no part,
nor do rows without vec_id.  Rows that share the query's vec_id are its own.
Only vectors of the query's length are candidates.  Ties go to the smaller
vec_id; repeated rows each count.  Whole numbers travel as doubles, which
hold floor(256 * x) exactly at any size; where a double cannot hold a score,
Python numbers do.  A score beyond the range of a long counts as its nearest
end.  An empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histlake.llm.common import prepare, saved
from histlake.llm.vectors import finite, matrices

PIVOTS = 32
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192
SHELF = 256                  # vectors that share a bound and are scored at a time
ROUNDING = 1e-12             # of a distance, relative
EDGE = (1 << 63) - 1
FREE = -EDGE - 1             # below all scores: a free place in a list


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, v: the rows that take part, components floored to whole numbers."""
    x = F.transform(column, lambda c: 256 * c.cast("double"))
    # floor() gives a long; a double beyond 2^52 is whole already
    v = F.transform(x, lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c))
    fits = F.forall(x, lambda c: F.abs(c) < float("inf"))
    return vectors.where(F.col("vec_id").isNotNull() & finite(column)).where(fits).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def distances(x: np.ndarray, pivots: list[list[int]]) -> np.ndarray:
    """Of every row of ``x`` to every pivot."""
    out = np.empty((len(x), len(pivots)))
    for i, p in enumerate(pivots):
        away = np.abs(x - np.array(p, float))
        top = np.maximum(1.0, away.max(1, initial=0))                # squares of large components would overflow
        if (top > 1e100).any():
            out[:, i] = top * np.sqrt(((away / top[:, None]) ** 2).sum(1))
        else:
            out[:, i] = np.sqrt(np.einsum("ij,ij->i", away, away))
    return out


def pivot_table(rows: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """Adds ``d``, the distances to the pivots of the vector's length."""
    def run(batches):
        by_dim: dict[int, list] = {}
        for p in pivots:
            by_dim.setdefault(len(p), []).append(p)
        for b in batches:
            dist = [None] * b.num_rows
            for at, x in matrices(b.column("v")):
                for i, d in zip(at.tolist(), distances(x, by_dim.get(x.shape[1], [])), strict=True):
                    dist[i] = d
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dist, pa.list_(pa.float64()))],
                                             names=[*b.schema.names, "d"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, d array<double>")


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(len(column), -1)


def exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in Python numbers, held within a long."""
    own = [int(c) for c in q]
    return np.array([max(-EDGE, min(EDGE, sum(int(a) * b for a, b in zip(r, own, strict=True)))) for r in rows], np.int64)


def shelves(d: np.ndarray) -> list[np.ndarray]:
    """Rows of the pivot table in lots of ``SHELF`` at most, near in the table;
    a lot's rows keep their order."""
    n = len(d)
    if not d.shape[1]:
        return np.split(np.arange(n), np.arange(SHELF, n, SHELF))
    near = d.argmin(1)
    order = np.lexsort((d[np.arange(n), near], near))
    heads = np.flatnonzero(np.r_[True, near[order][1:] != near[order][:-1]])
    place = np.arange(n) - np.repeat(heads, np.diff(np.r_[heads, n]))
    return [np.sort(own) for own in np.split(order, np.flatnonzero(place % SHELF == 0)[1:])]


def shelf_bounds(d: np.ndarray, x: np.ndarray, dq: np.ndarray, q: np.ndarray, lots: list[np.ndarray]) -> np.ndarray:
    """Upper bound of the scores of each query on each shelf."""
    out = np.empty((len(q), len(lots)))
    with np.errstate(over="ignore", invalid="ignore"):
        sq, sx = (q * q).sum(1), (x * x).sum(1)
        for i, own in enumerate(lots):
            low, high = d[own].min(0), d[own].max(0)
            gap = np.maximum(dq - high, low - dq) - ROUNDING * (dq + high)
            gap = np.maximum(gap, 0).max(1, initial=0)
            both = sq + sx[own].max()
            out[:, i] = (both - gap * gap) / 2 + 1 + 1e-9 * both     # for rounding
    out[~np.isfinite(out)] = np.inf                                  # beyond a double: no bound
    return np.maximum(out, FREE)                                     # scores end there as well


def score_shelf(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, exact: bool, best: np.ndarray, best_id: np.ndarray) -> None:
    """Scores a shelf for some queries and puts what is better into their lists."""
    k = best.shape[1]
    got = (q @ x.T).astype(np.int64) if exact else np.stack([exact_scores(x, one) for one in q])
    got[ids == qids[:, None]] = FREE
    least = best[:, -1]
    if len(x) > k and (least == FREE).any():
        least = np.maximum(least, np.partition(got, len(x) - k, axis=1)[:, len(x) - k])
    i, j = np.nonzero(got >= least[:, None])
    value, vec = got[i, j], ids[j]
    better = (value > best[i, -1]) | ((value > FREE) & (value == best[i, -1]) & (vec < best_id[i, -1]))
    i, value, vec = i[better], value[better], vec[better]
    some = np.unique(i)
    i = np.r_[i, np.repeat(some, k)]
    value, vec = np.r_[value, best[some].ravel()], np.r_[vec, best_id[some].ravel()]
    order = np.lexsort((vec, np.invert(value), i))
    order = order[np.arange(len(order)) - np.searchsorted(i[order], i[order]) < k]
    best[some], best_id[some] = value[order].reshape(-1, k), vec[order].reshape(-1, k)


def block_top(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> tuple[list, int]:
    """(query_id, vec_id, score) of the k best in one block, and the number
    of candidates that were scored."""
    out, scored = [], 0
    vectors = vectors.sort_values("vec_id", kind="stable")
    dims = vectors["v"].map(len)
    for dim, part in queries.groupby(queries["v"].map(len)):
        own = vectors[dims == dim]
        if own.empty:
            continue
        x, dx, ids = _matrix(own["v"]), _matrix(own["d"]), own["vec_id"].to_numpy()
        q, dq, qids = _matrix(part["v"]), _matrix(part["d"]), part["vec_id"].to_numpy()
        exact = dim * max(1.0, np.abs(x).max(initial=0)) * max(1.0, np.abs(q).max(initial=0)) < 2**52
        lots = shelves(dx)
        upper = shelf_bounds(dx, x, dq, q, lots)
        best, best_id = np.full((len(q), k), FREE, np.int64), np.full((len(q), k), EDGE, np.int64)
        first = upper.argmax(1)
        for promising in (True, False):
            for i, shelf in enumerate(lots):
                who = np.flatnonzero(first == i if promising else (first != i) & (upper[:, i] >= best[:, -1]))
                if len(who):
                    mine, its = best[who], best_id[who]
                    score_shelf(x[shelf], ids[shelf], q[who], qids[who], exact, mine, its)
                    best[who], best_id[who] = mine, its
                    scored += len(who) * len(shelf)
        i, j = np.nonzero(best > FREE)
        out += zip(qids[i].tolist(), best_id[i, j].tolist(), best[i, j].tolist(), strict=True)
    return out, scored


def top_k(vectors: DataFrame, query_rows, k: int = 5, column: str = "embedding",
          query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score; ``query_rows`` is a condition on vec_id."""
    prepare(vectors.sparkSession)
    rows = integer_vectors(vectors, column)
    pivots = [r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(PIVOTS).select("v").collect()]
    rows = saved(pivot_table(rows, pivots), "pivot-table")
    q = rows.where(query_rows)
    n, m = rows.count(), q.count()
    blocks, qblocks = max(1, -(-n // vector_block)), max(1, -(-m // query_block))
    deal = lambda count, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(count)).cast("int")
    left = q.withColumn("qb", deal(qblocks, 1)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("vb", deal(blocks, 2)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found, _ = block_top(a, b, k) if len(a) and len(b) else ([], 0)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    part = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return part.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda t: t[1] * t[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
