"""Verdicts of the outlier estimate and scores of the additive model against
plain versions."""

from __future__ import annotations

import math
import random

import numpy as np

from histlake.llm import op7_quality_rules as Q
from histlake.llm import op8_quality_gam as G
from histlake.llm.common import table

SF = "/root/testdata/sf0.01"


# -- op7 -----------------------------------------------------------------------

def vector(r):
    n = max(r.n_words, 1)
    x = (math.log(n), r.word_chars / n, math.log1p(100 * r.n_symbols / n), r.n_dup_lines / max(r.n_lines, 1), r.n_repeat_words / n)
    return [math.floor(Q.SCALE * v + 0.5) for v in x]


def shortest_half(values):
    """Middle and length of the shortest run of bins that holds half the values."""
    bins = sorted(math.floor(v / 16) for v in values)
    half = (len(bins) + 1) // 2
    best = None
    for first in sorted(set(bins)):
        later = [b for b in bins if b >= first]
        if len(later) >= half:
            length = later[half - 1] - first
            if best is None or length < best[0]:
                best = (length, first)
    length, first = best
    return (first + (length + 1) / 2) * 16 / Q.SCALE, (length + 1) * 16 / Q.SCALE


def brute_distances(vectors):
    """Squared distances after the concentration steps, row by row."""
    v = np.array(vectors, float) / Q.SCALE
    start = [shortest_half([x[i] for x in vectors]) for i in range(Q.DIM)]
    mean = np.array([m for m, _ in start])
    inverse = np.diag([1 / max(s / 1.35, f) ** 2 for (_, s), f in zip(start, Q.FLOOR, strict=True)])
    for _ in range(Q.STEPS):
        d = v - mean
        d2 = np.array([x @ inverse @ x for x in d])
        bins = np.floor(16 * np.log2(d2 + 2.0 ** -10)).astype(int)
        last = sorted(bins)[math.ceil(Q.SUPPORT * len(bins)) - 1]
        near = v[bins <= last]
        mean = near.mean(0)
        cov = Q.CONSISTENCY * np.cov(near.T, bias=True) + np.diag(np.square(Q.FLOOR))
        inverse = np.linalg.inv(cov)
    return [x @ inverse @ x for x in v - mean]


def test_verdicts_match_a_plain_estimate(spark):
    docs = table(spark, SF, "documents")
    stats = {r.doc_id: r for r in Q.statistics(docs).collect()}
    out = {r.doc_id: r for r in Q.quality_rules(docs).collect()}
    good = [r for d, r in stats.items() if not out[d].base_failed]
    size = {}
    for r in good:
        size[r.lang, r.source] = size.get((r.lang, r.source), 0) + 1
    groups = {}
    for r in good:
        groups.setdefault((r.lang, r.source if size[r.lang, r.source] >= Q.MIN_GROUP else ("pooled",)), []).append(r)
    judged = 0
    for rows in groups.values():
        if len(rows) < Q.MIN_GROUP:
            assert all(out[r.doc_id].kept for r in rows)
            continue
        for r, d2 in zip(rows, brute_distances([vector(r) for r in rows]), strict=True):
            assert abs(out[r.doc_id].distance - d2) <= 1e-6 * max(1, d2)
            assert out[r.doc_id].kept == (d2 <= Q.CUTOFF)
            judged += 1
    assert judged > 300 and any(not out[r.doc_id].kept for r in good)


# -- op8 -----------------------------------------------------------------------

def brute_score(model, x):
    """One row, table by table."""
    total = model.base
    bins = [sum(1 for e in edges if e <= value) for edges, value in zip(model.edges, x, strict=True)]
    for lookup, b in zip(model.mains, bins, strict=True):
        total += lookup[b]
    for i, j, lookup in model.pairs:
        total += lookup[bins[i] * model.GRID // len(model.mains[i])][bins[j] * model.GRID // len(model.mains[j])]
    return 1 / (1 + math.exp(-total))


def test_scores_match_a_plain_sum_of_lookups(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    features = G.feature_table(docs)
    model = G.fit_model(features, labels)
    assert model.mains and model.pairs
    x = {r["doc_id"]: [r[f] for f in G.FEATURES] for r in features.collect()}
    for r in G.quality_scores(docs, labels).collect():
        assert abs(r.score - brute_score(model, x[r.doc_id])) < 1e-9
        assert r.predicted == int(r.score >= G.THRESHOLD)


def test_fit_sample_is_bounded_and_follows_the_ids(spark):
    rng = random.Random(2)
    rows = [(i, *[rng.random() for _ in G.FEATURES]) for i in range(4000)]
    features = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{f} double" for f in G.FEATURES))
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    seen = []
    fit = G.Gam.fit
    try:
        G.Gam.fit = lambda self, x, y: (seen.append(len(y)), fit(self, x, y))[1]
        G.fit_model(features, labels, max_rows=500)
        G.fit_model(features, labels)
    finally:
        G.Gam.fit = fit
    assert 350 <= seen[0] <= 500 and 3000 < seen[1] < 3400      # a fifth is held out
