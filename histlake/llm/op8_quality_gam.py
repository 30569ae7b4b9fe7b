"""Quality classifier: a generalised additive model with pair interactions.

score = sigmoid(base + sum of one lookup per feature + sum of one lookup per
chosen feature pair).  Cyclic boosting visits the features in turn; each visit
fits one shallow tree on the feature's bins to the current residual and adds
it to that feature's lookup table.  Pairs are ranked by how much a grid of
cells would still explain, the best get two-dimensional tables the same way.
Scoring adds table entries, vectorised over a batch.

The model is fitted on a bounded sample of labelled rows (about 0.9
``max_rows`` by a threshold on a hash of doc_id, at most ``max_rows``); features, scores and the
held-out split cover every document.  Inputs are text statistics only, never
lang, source, doc_id or labels.

Null text counts as empty and is scored like any other; null labels are not
learnt from; a null doc_id is not held out and never learnt from.  Without
both classes among the labels the score is the base rate (0.5 without any).
A repeated doc_id gets a row and counts in the fit for each of its documents
and labels; splits of equal gain take the first.  An empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import hashed_words, prepare, saved, slices, text_column, with_bytes
from histlake.llm.text_stats import SYMBOLS, WHITE, code_points, duplicate_lines, repeated_words

FEATURES = ("log_words", "word_chars", "symbols", "upper", "exclaims", "bars", "stops", "digits", "high",
            "dup_lines", "line_words", "repeat1", "repeat2", "repeat3", "adjacent")
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
HIGH = bytes(range(128, 256))
THRESHOLD = 0.3
MAX_FIT_ROWS = 20_000


def features(texts: list[bytes]) -> np.ndarray:
    """One row of statistics for each text."""
    h, counts = hashed_words(texts)
    words = np.maximum(counts, 1)
    count = lambda t, chars: len(t) - len(t.translate(None, chars))
    raw = np.array([(code_points(t.translate(None, WHITE)), count(t, SYMBOLS), count(t, UPPER), t.count(b"!"),
                     t.count(b"|"), t.count(b"."), count(t, DIGITS), count(t, HIGH), *duplicate_lines(t))
                    for t in texts], float).reshape(len(texts), 10)
    chars = np.maximum(raw[:, 0], 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    next_same = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1]) if len(h) else np.zeros(0, bool)
    adjacent = np.bincount(owner[1:][next_same], minlength=len(counts)) if len(h) else np.zeros(len(counts))
    return np.column_stack([
        np.log1p(counts), raw[:, 0] / words, raw[:, 1] / words, raw[:, 2] / chars, raw[:, 3] / words,
        raw[:, 4] / words, raw[:, 5] / words, raw[:, 6] / chars, raw[:, 7] / chars,
        raw[:, 9] / np.maximum(raw[:, 8], 1), np.log1p(words / np.maximum(raw[:, 8], 1)),
        repeated_words(h, counts, 1) / words, repeated_words(h, counts, 2) / words,
        repeated_words(h, counts, 3) / words, adjacent / words])


def feature_table(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in slices(batches):
            x = features(text_column(b))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=["doc_id", *FEATURES])

    return with_bytes(docs, "doc_id").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Gam:
    """Lookup tables over binned features and feature pairs."""

    bins: int = 32
    rounds: int = 60
    pair_rounds: int = 20
    pairs_kept: int = 8
    rate: float = 0.3
    ridge: float = 5.0
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    mains: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    GRID = 8

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)])

    def _leaf(self, g: float, h: float) -> float:
        return self.rate * g / (h + self.ridge)

    def _tree(self, g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
        """Additions per bin of one shallow tree over ordered bins."""
        out = np.full(len(g), self._leaf(g.sum(), h.sum()))
        if depth == 0 or len(g) < 2:
            return out
        cg, ch = g.cumsum(), h.cumsum()
        gain = cg[:-1] ** 2 / (ch[:-1] + self.ridge) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + self.ridge)
        at = int(gain.argmax()) + 1
        if gain[at - 1] <= cg[-1] ** 2 / (ch[-1] + self.ridge) + 1e-9:
            return out
        return np.concatenate([self._tree(g[:at], h[:at], depth - 1), self._tree(g[at:], h[at:], depth - 1)])

    def _quadrants(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Additions per cell of the best tree with one cut on either axis."""
        cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
        tg, th = cg[-1, -1], ch[-1, -1]
        part = lambda c, t: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
                             t - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
        gs, hs = part(cg, tg), part(ch, th)
        gain = sum(a**2 / (b + self.ridge) for a, b in zip(gs, hs, strict=True))
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        out = np.empty_like(g)
        for k, (rows, cols) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
                                          (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
            out[rows, cols] = self._leaf(gs[k][i, j], hs[k][i, j])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Gam:
        if len(y) == 0 or y.min() == y.max():
            rate = 0.5 if len(y) == 0 else float(y[0])
            self.base = float(np.log((rate + 0.01) / (1.01 - rate)))
            return self
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        q = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, i], q)) for i in range(x.shape[1])]
        self.mains = [np.zeros(len(e) + 1) for e in self.edges]
        b = self.binned(x)
        score = np.full(len(y), self.base)

        def residual():
            p = 1 / (1 + np.exp(-score))
            return y - p, p * (1 - p)

        for _ in range(self.rounds):
            for i, lookup in enumerate(self.mains):
                g, h = residual()
                add = self._tree(np.bincount(b[:, i], g, len(lookup)), np.bincount(b[:, i], h, len(lookup)))
                lookup += add
                score += add[b[:, i]]
        coarse = [b[:, i] * self.GRID // len(m) for i, m in enumerate(self.mains)]
        g, h = residual()
        ranked = []
        for i in range(len(coarse)):
            for j in range(i + 1, len(coarse)):
                cell = coarse[i] * self.GRID + coarse[j]
                sg, sh = np.bincount(cell, g, self.GRID**2), np.bincount(cell, h, self.GRID**2)
                ranked.append((float((sg**2 / (sh + self.ridge)).sum()), i, j))
        for _, i, j in sorted(ranked, reverse=True)[: self.pairs_kept]:
            self.pairs.append((i, j, np.zeros((self.GRID, self.GRID))))
        for _ in range(self.pair_rounds):
            for i, j, lookup in self.pairs:
                g, h = residual()
                cell = coarse[i] * self.GRID + coarse[j]
                add = self._quadrants(np.bincount(cell, g, self.GRID**2).reshape(lookup.shape),
                                      np.bincount(cell, h, self.GRID**2).reshape(lookup.shape))
                lookup += add
                score += add.ravel()[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.edges:
            b = self.binned(x)
            for i, lookup in enumerate(self.mains):
                total += lookup[b[:, i]]
            for i, j, lookup in self.pairs:
                total += lookup[b[:, i] * self.GRID // len(self.mains[i]), b[:, j] * self.GRID // len(self.mains[j])]
        return 1 / (1 + np.exp(-total))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_model(table: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Gam:
    """Fit on at most ``max_rows`` labelled rows outside the held-out part.

    The rows are taken by a threshold on a hash of doc_id that follows from
    the number of labels, so only about that many leave the executors; ids
    with very many labels could still pass it, and the limit holds for them."""
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("double").alias("label"))
    known = known.where(~held_out())
    share = min(1.0, 0.9 * max_rows / max(1, known.count()))
    bound = min((1 << 63) - 1, int(share * (1 << 63)))
    known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) <= F.lit(bound))
    rows = table.join(known, "doc_id").select("doc_id", "label", *FEATURES).limit(max_rows)
    pdf = rows.toPandas().sort_values(["doc_id", "label", *FEATURES], kind="stable")
    return Gam().fit(pdf[list(FEATURES)].to_numpy(float), pdf["label"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    table = saved(feature_table(docs), "gam-features")
    model = fit_model(table, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy() for f in FEATURES])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    out = table.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
