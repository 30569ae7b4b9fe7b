"""Whitening of embeddings by spectral divide and conquer.

Entries c become whole numbers x = floor(64 * c) + 1000000.  The fit list
holds each distinct vector x once; its covariance V (divisor n, centred
before multiplying) is summed by tasks and only the d x d result reaches the
driver, where it is split into eigenvectors:

* the polar factor U of V - sI, by the dynamically weighted Halley iteration
  (QR steps while the weights are large, Cholesky steps after that), is the
  matrix sign of V - sI;
* (U + I) / 2 projects on the eigenvectors above the shift s: a basis of its
  range and of the complement cuts V into two smaller blocks;
* each block is split the same way until it is one number.

The components go to the tasks as one broadcast d x k matrix and every row
is projected there.  Distances from the mean stay exact: n * x - S is whole.

Rows whose vector is null or holds null or non-finite entries are dropped,
as are vectors with an entry whose x is beyond a long.  A null vec_id stays.
Repeated rows each get their result; they count once in the fit.  Vectors of
another length form a fit of their own.  A component without variance
(relative to the largest) has whitened and explained 0 and does not count in
identity_error; ``deviation`` is null where it does not fit a long.  Vectors
of fewer than 16 entries have that many components, empty ones none; an
empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import prepare, saved, slices
from histlake.llm.vectors import finite, matrices

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LONG = 1 << 62               # whole numbers below it are summed as longs
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


# -- whole numbers -------------------------------------------------------------

def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x of the rows that take part."""
    scaled = F.transform(column, lambda c: F.floor(SCALE * c.cast("double")))
    fits = F.forall(F.transform(column, lambda c: SCALE * c.cast("double")), lambda c: F.abs(c) < float(LONG))
    return vectors.where(finite(column)).where(fits).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(scaled, lambda c: c + SHIFT).alias("x"))


def off_mean(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S, exact: longs where they fit, else Python numbers."""
    top = n * max(1, int(np.abs(x).max(initial=0))) + max((abs(t) for t in total), default=0)
    if top >= LONG:
        x = x.astype(object)
    return x * n - np.array(total, x.dtype)[None, :]


def squared_size(away: np.ndarray) -> list[int | None]:
    """Exact sum of squares by row; null beyond a long."""
    top = int(np.abs(away).max(initial=0))
    if top * top * max(1, away.shape[1]) >= LONG:
        away = away.astype(object)
    sums = [int(s) for s in (away * away).sum(1)]
    return [s if s < 1 << 63 else None for s in sums]


# -- sums over the fit list ------------------------------------------------------

def _sums(batches):
    """Per task and length: n and the sum of each dimension."""
    acc: dict[int, list] = {}
    for b in batches:
        for _, x in matrices(b.column("x")):
            at = acc.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            big = int(np.abs(x).max(initial=0)) * max(1, len(x)) >= LONG
            at[0] += len(x)
            at[1] = [a + int(s) for a, s in zip(at[1], (x.astype(object) if big else x).sum(0), strict=True)]
    rows = [(dim, i, n, Decimal(s)) for dim, (n, total) in acc.items() for i, s in enumerate(total or [0])]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)))],
        names=["dim", "i", "n", "s"])


def means(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Length -> n and the exact sums; d numbers per length of vector."""
    rows = fit.mapInArrow(_sums, "dim int, i int, n long, s decimal(38,0)").groupBy("dim", "i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for dim in {r["dim"] for r in rows}:
        own = sorted((r["i"], r["n"], int(r["s"])) for r in rows if r["dim"] == dim)
        out[dim] = (own[0][1], [s for _, _, s in own][:dim])
    return out


def products(fit: DataFrame, mean: dict, map_: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """Length -> covariance of the centred vectors (or of their images under
    ``map_``); tasks add up matrices, the sums go by row."""
    shared = fit.sparkSession.sparkContext.broadcast((mean, map_))

    def run(batches):
        mean, map_ = shared.value
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in matrices(b.column("x")):
                dim = x.shape[1]
                n, total = mean[dim]
                y = (off_mean(x, n, total) / n).astype(float)
                y = y if map_ is None else y @ map_[dim]
                acc[dim] = acc.get(dim, 0) + y.T @ y
        rows = [(dim, i, line) for dim, m in acc.items() for i, line in enumerate(m)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.list_(pa.float64()))], names=["dim", "i", "line"])

    cells = fit.mapInArrow(run, "dim int, i int, line array<double>").select("dim", "i", F.posexplode("line").alias("j", "v"))
    lines = cells.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    size = {dim: (dim if map_ is None else map_[dim].shape[1]) for dim in mean}
    out = {dim: np.zeros((k, k)) for dim, k in size.items()}
    for r in lines:
        out[r["dim"]][r["i"], r["j"]] = r["v"] / mean[r["dim"]][0]
    return out


# -- spectral divide and conquer ---------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix; for a symmetric matrix
    this is its matrix sign."""
    d = len(a)
    eye = np.eye(d)
    x = a / np.linalg.norm(a)
    with np.errstate(all="ignore"):
        r = np.abs(np.diagonal(np.linalg.qr(x)[1]))
    low = max(float(r.min()) / np.sqrt(d), np.finfo(float).eps)   # smallest singular value, from below
    for _ in range(60):
        cube = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + cube)
        p = root + np.sqrt(max(0.0, 8 - 4 * cube + 8 * (2 - low * low) / (low * low * root))) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            new = q / r * x + (p - q / r) / np.sqrt(r) * both[:d] @ both[d:].T
        else:
            half = np.linalg.cholesky(eye + r * x.T @ x)
            new = q / r * x + (p - q / r) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (p + q * low * low) / (1 + r * low * low))
        if moved < 1e-12 * np.sqrt(d) and 1 - low < 1e-14:
            break
    return x


def _halves(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift inside
    the spectrum; None if the block is a multiple of the identity."""
    d, scale = len(a), np.linalg.norm(a)
    diagonal = np.sort(np.diagonal(a))
    best = None
    for attempt in range(12):
        shift = np.median(diagonal) if attempt == 0 else np.trace(a) / d if attempt == 1 else (
            # a shift that sits on an eigenvalue has no sign there: move it
            np.quantile(diagonal, rng.uniform(0.1, 0.9)) + rng.normal() * 1e-3 * np.std(diagonal))
        moved = a - shift * np.eye(d)
        if np.linalg.norm(moved) <= 4 * np.finfo(float).eps * d * scale:
            return None
        above = (polar_factor(moved) + np.eye(d)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < d:
            continue
        basis = np.linalg.qr(above @ rng.normal(size=(d, k)))[0]
        basis = np.linalg.qr(above @ basis, "complete")[0]
        up, down = basis[:, :k], basis[:, k:]
        cross = np.linalg.norm(down.T @ a @ up)
        if best is None or cross < best[0]:
            best = (cross, up, down)
        if cross <= 100 * np.finfo(float).eps * scale:
            break
    return None if best is None else best[1:]


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    rng = np.random.default_rng(11)
    out = []
    todo = [np.eye(len(v))]
    while todo:
        basis = todo.pop()
        if not basis.shape[1]:
            continue
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        halves = _halves(block, rng) if basis.shape[1] > 1 else None
        if halves is None:   # one vector, or any basis will do
            out += [(float(block[i, i]), basis[:, i]) for i in range(basis.shape[1])]
        else:
            todo += [basis @ h for h in halves]
    out.sort(key=lambda e: -e[0])
    return np.array([e for e, _ in out]), np.array([w / np.linalg.norm(w) for _, w in out]).reshape(-1, len(v)).T


# -- the operator ---------------------------------------------------------------------

def components(v: np.ndarray, limit: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The d x k matrix that whitens centred vectors, and the explained shares."""
    e, w = eigenvectors(v)
    live = e > max(e.max(initial=0.0), 0.0) * len(v) * 1e-14
    scale = np.where(live, 1 / np.sqrt(np.where(live, e, 1)), 0)
    total = float(np.trace(v))
    share = np.where(live, e, 0) / total if total > 0 else np.zeros(len(e))
    return (w * scale[None, :])[:, :limit], share[:limit]


def whiten(vectors: DataFrame, column: str = "embedding", limit: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    spark = prepare(vectors.sparkSession)
    rows = whole_vectors(vectors, column)
    fit = saved(rows.select("x").distinct(), "whitening-fit")
    mean = means(fit)
    parts = {dim: components(v, limit) for dim, v in products(fit, mean).items()}
    spread = products(fit, mean, {dim: m for dim, (m, _) in parts.items()})
    error = {}
    for dim, c in spread.items():
        live = parts[dim][1] > 0
        error[dim] = float(np.abs(c - np.eye(len(c)))[np.ix_(live, live)].max(initial=0))
    shared = spark.sparkContext.broadcast((mean, parts, error))

    def run(batches):
        mean, parts, error = shared.value
        for b in slices(batches):
            ids = b.column("vec_id").to_pylist()
            for at, x in matrices(b.column("x")):
                dim = x.shape[1]
                (n, total), (m, share) = mean[dim], parts[dim]
                k = m.shape[1]
                away = off_mean(x, n, total)
                y = (away / n).astype(float) @ m
                size = squared_size(away)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in at for _ in range(k)], pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, n)), pa.array([s for s in size for _ in range(k)], pa.int64()),
                    pa.array(y.reshape(-1)), pa.array(np.tile(share, len(at))), pa.array(np.full(len(at) * k, error[dim]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, RESULT)
