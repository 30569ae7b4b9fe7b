"""Whitening and hard negatives against brute force, and their edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from histlake.llm import op11_whitening as W
from histlake.llm import op13_hard_negatives as H
from histlake.llm.common import table

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
#: columns whose names the operators use inside
CLASH = "vec_id long, label int, embedding array<float>, x string, v string, n int, key string, score int, dim int, align int"


def frame(spark, rows, schema="vec_id long, label int, embedding array<float>"):
    more = len(schema.split(",")) - 3
    return spark.createDataFrame([(*r, *[None] * more) for r in rows], schema)


# -- op11 ----------------------------------------------------------------------

def brute_whitening(vectors):
    """x, n, S, eigenvalues and vectors of the distinct whole vectors."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, total = len(fit), fit.sum(0)
    c = ((fit * n - total) / n).astype(float)
    e, w = np.linalg.eigh(c.T @ c / n)
    return x, n, total, e[::-1], w[:, ::-1]


@pytest.mark.parametrize("d", [1, 2, 7, 40, 130])
def test_divide_and_conquer_finds_all_eigenvectors(d):
    a = np.random.default_rng(d).normal(size=(d, 2 * d))
    v = a @ a.T
    e, w = W.eigenvectors(v)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1], atol=1e-12 * e[0])
    assert np.allclose(w.T @ w, np.eye(d), atol=1e-13) and np.allclose(v @ w, w * e, atol=1e-12 * e[0])


@pytest.mark.parametrize("v", [np.zeros((0, 0)), np.zeros((3, 3)), 2 * np.eye(4), np.diag([1.0, 1, 2, 2, 3]), np.ones((5, 5)),
                               np.diag([1e-12, 1, 1, 1e9])], ids=["none", "zero", "identity", "equal", "rank1", "wide"])
def test_repeated_and_missing_eigenvalues(v):
    e, w = W.eigenvectors(v)
    assert np.allclose(w.T @ w, np.eye(len(v)), atol=1e-13)
    assert np.allclose(v @ w, w * e, atol=1e-13 * max(1, e.max(initial=0)))
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1] if len(v) else [], atol=1e-13 * max(1, e.max(initial=0)))


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(9, 9)))[0]
    e = np.array([-5, -1e-3, 1e-3, 1, 2, 3, -3, 1e6, -1e6])
    assert np.allclose(W.polar_factor(q * e @ q.T), q * np.sign(e) @ q.T, atol=1e-5)


def check_whitening(rows, vectors, ids):
    x, n, total, e, w = brute_whitening(vectors)
    k = min(16, x.shape[1])
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(vectors) * k
    y = ((x * n - total) / n).astype(float) @ w[:, :k] / np.sqrt(e[:k])
    mine = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    sign = np.sign((mine * y).sum(0))
    assert np.allclose(mine * sign, y, atol=1e-7)
    for row, i in zip(x, ids, strict=True):
        r = got[i, 1]
        assert r["n"] == n and r["deviation"] == sum(int(n * c - s) ** 2 for c, s in zip(row, total, strict=True))
    assert all(abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-10 for r in rows)
    assert all(r["identity_error"] < 1e-9 for r in rows)


def test_whitening_matches_brute_force(spark):
    t = table(spark, SF, "embeddings")
    rows = t.collect()
    check_whitening(W.whiten(t).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows])


def test_whitening_counts_copies_once_and_drops_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, 0, [float(c) for c in rng.normal(size=5)]) for i in range(40)]
    copies = [(100 + i, 1, good[0][2]) for i in range(30)]
    odd = [(200, 0, None), (201, 0, [1.0, None, 0.0, 0.0, 0.0]), (202, 0, [NAN] * 5), (203, None, [INF, 0.0, 0.0, 0.0, 0.0]),
           (204, 0, [3e38] * 5)]
    out = W.whiten(frame(spark, [*good, *copies, *odd], CLASH)).collect()
    check_whitening(out, [np.float32(r[2]) for r in good + copies], [r[0] for r in good + copies])


def test_whitening_of_flat_short_and_other_lengths(spark):
    flat = [(i, 0, [1.0, float(i), 2.0]) for i in range(6)]      # one direction with variance
    other = [(10, 0, [0.5]), (11, 0, [0.5]), (None, 0, [2.5]), (12, 0, [])]
    out = W.whiten(frame(spark, flat + other)).collect()
    by = {(r["vec_id"], r["component"]): r for r in out}
    assert len(out) == 6 * 3 + 3
    assert all(by[i, c]["whitened"] == 0 and by[i, c]["explained"] == 0 for i in range(6) for c in (2, 3))
    assert np.allclose(sorted(abs(by[i, 1]["whitened"]) for i in range(6)), sorted(abs((i - 2.5) / np.sqrt(35 / 12)) for i in range(6)))
    assert by[10, 1]["n"] == by[None, 1]["n"] == 2 and by[10, 1]["deviation"] == by[None, 1]["deviation"] == 128 ** 2
    same = W.whiten(frame(spark, [(1, 0, [1.0, 2.0])] * 3)).collect()
    assert {(r["whitened"], r["explained"], r["deviation"], r["n"], r["identity_error"]) for r in same} == {(0.0, 0.0, 0, 1, 0.0)}


def test_deviation_beyond_a_long_is_null_and_large_numbers_stay_exact():
    x = np.array([[1 << 50, 0], [-(1 << 50), 1]], np.int64)
    away = W.off_mean(x, 1 << 14, [0, 0])
    assert [int(a) for a in away[0]] == [1 << 64, 0] and W.squared_size(away) == [None, None]
    assert W.squared_size(np.array([[(1 << 31) + 1, 5]], np.int64)) == [((1 << 31) + 1) ** 2 + 25]


# -- op13 ----------------------------------------------------------------------

def brute_negatives(rows, every=100):
    """By the definition, with Python numbers."""
    use = {(i, lab, tuple(v)) for i, lab, v in rows}
    out = set()
    for i, lab, v in use:
        if i % every:
            continue
        score = lambda o: sum(a * b for a, b in zip(v, o, strict=True))
        near = sorted((-score(o), j, m) for j, m, o in rows if j != i and len(o) == len(v))
        for s, j, _ in [x for x in near if x[2] == lab][:5]:
            fits = [(n, k) for n, k, m in near if m != lab and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out |= {(i, j, r + 1, k, -s, -n) for r, (n, k) in enumerate(fits)}
    return out


def negatives(spark, rows, schema="vec_id long, label int, embedding array<float>", **kw):
    out = H.hard_negatives(frame(spark, rows, schema), F.col("vec_id") % 100 == 0, **kw).drop("positive_rank").collect()
    return [tuple(r) for r in out]


def whole(rows):
    return [(i, lab, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, lab, v in rows]


@pytest.mark.parametrize("dim", [1, 3, 64, 70])
def test_negatives_match_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(8, dim))
    rows = [(i, int(rng.integers(3)), [float(c) for c in base[i % 8] + rng.normal(size=dim) * 0.3]) for i in range(700)]
    out = negatives(spark, rows, anchor_bytes=2000)      # several lots of anchors
    assert len(out) == len(set(out)) > 20 and set(out) == brute_negatives(whole(rows))


def test_negatives_with_ties_zeros_odd_rows_and_clashing_names(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 4, [float(c) for c in rng.integers(-2, 3, 6)]) for i in range(500)]   # many equal scores
    rows += [(900 + i, i % 4, [0.0] * 6) for i in range(8)] + [(1000, 0, [0.0] * 6), (1100, 2, [1.0, 0.0])]
    odd = [(None, 1, [1.0] * 6), (2000, None, [1.0] * 6), (2100, 1, None), (2200, 1, [NAN] * 6), (2300, 1, [None] * 6),
           (2400, 1, [INF] * 6)]
    out = negatives(spark, rows + odd, CLASH)
    assert len(out) == len(set(out)) and set(out) == brute_negatives(whole(rows))


def test_repeated_anchors_and_large_components(spark):
    big = float(1 << 21)
    rows = [(0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (1, 1, [2 * big, 0.0]), (2, 1, [big, 0.0]), (3, 2, [1.9 * big, 0.0]),
            (4, 2, [0.9 * big, 0.0]), (4, 2, [0.9 * big, 0.0])]
    assert sorted(negatives(spark, rows)) == sorted(
        [(0, 1, 1, 3, 1 << 38, rows[4] and int(256 * np.float32(1.9 * big)) * 256),
         *[(0, 2, r, 4, 1 << 37, int(256 * np.float32(0.9 * big)) * 256) for r in (1, 2)]])
    huge = [(0, 1, [3e38]), (1, 1, [3e38]), (2, 2, [2.9e38]), (3, 2, [1e38])]
    assert sorted(negatives(spark, huge)) == [(0, 1, 1, 2, H.EDGE, H.EDGE), (0, 1, 2, 3, H.EDGE, H.EDGE)]   # all at the end of a long


def test_intervals_hold_all_scores_and_spare_products():
    rng = np.random.default_rng(7)
    v = np.floor(256 * rng.normal(size=(3000, 64)))
    v[:40] = v[100] + np.round(rng.normal(size=(40, 64)) * 20)
    size, align, code = H.encode(v)
    a = H.Anchor(1, -1, 0, v[100])
    low, high = a.interval(size, align, code)
    score = v @ v[100]
    assert (low <= score).all() and (score <= high).all()
    assert (high >= np.sort(score)[-5]).mean() < 0.2       # most rows need no product


def test_empty_tables_give_no_rows(spark):
    none = frame(spark, [])
    assert W.whiten(none).count() == 0
    assert H.hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0
    assert negatives(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []       # no anchor
