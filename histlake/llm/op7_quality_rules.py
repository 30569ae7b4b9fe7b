"""Quality rules by robust multivariate outliers.

Base rules reject a document outright.  The rest is judged per language and
source: a minimum-covariance-determinant (MCD) estimate of the transformed
statistic vector, and a rejection by Mahalanobis distance.

* Every statistic covers the whole text; a null text has no words.
* The MCD concentration steps run as grouped Spark aggregates over all
  documents that pass the base rules: each step keeps the ``SUPPORT`` share
  of smallest distances of its group and re-estimates mean and covariance
  from them.  Vectors are fixed-point integers, so the sums are exact and do
  not depend on the order of rows.
* The first distances use, per coordinate, the shortest interval that holds
  half of the group (its middle and length), which a third of junk in a group
  does not move.
* The h-th smallest distance comes from a histogram of distance (powers of
  2 ** (1/16)), hence a group keeps at least ``SUPPORT`` of its rows, ties
  included; a hot group only adds to counters.
* Groups with fewer than ``MIN_GROUP`` documents share one estimate of their
  language; a language with fewer is not judged (all kept).
* The floors bound a squared distance by the sum of (deviation / floor)^2.
  A repeated-word share is at most 0.5 past the base rules, so it adds 39 at
  most and never reaches ``CUTOFF`` by itself; an equal-line share must
  deviate by over 0.71.  ``CUTOFF`` is no quantile of a distribution.
* Null ``lang`` or ``source`` is a group of its own; repeated rows count as
  often as they occur, null and repeated doc_ids each get their rows; ties of
  distance fall on one side; an empty table gives no rows; further columns
  are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import prepare, saved, sized, slices, text_column, with_bytes
from histlake.llm.text_stats import basic

DIM = 5
SCALE = 1024                 # fixed point of the vectors
SUPPORT = 0.6                # share of a group in the concentration set
CONSISTENCY = 1.69           # 0.6 / P(chi2_7 <= chi2_5(0.6)): makes the covariance of that share unbiased
STEPS = 4                    # concentration steps
MIN_GROUP = 100
CUTOFF = 80.0                # squared distance, after the consistency factor
#: Smallest standard deviation that a coordinate is given; keeps the
#: covariance regular where most documents of a group share a value.
FLOOR = (0.5, 0.25, 0.25, 0.08, 0.08)
BROADCAST_GROUPS = 20_000

STATS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def statistics(docs: DataFrame, keys: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """One row per document with its counts."""
    prepare(docs.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema)

    def run(batches):
        for b in slices(batches):
            s = basic(text_column(b))
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keys] + [pa.array(v) for v in s.values()],
                                             names=[*keys, *s])

    return with_bytes(docs, *keys).mapInArrow(run, f"{schema}, {STATS}")


def _vector() -> list:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    x = (F.log(n), F.col("word_chars") / n, F.log1p(100 * F.col("n_symbols") / n),
         F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_repeat_words") / n)
    return [F.round(SCALE * v).cast("long").alias(f"x{i}") for i, v in enumerate(x)]


def _estimate(pdf: pd.DataFrame) -> pd.DataFrame:
    """Mean and inverse covariance from the exact sums of one batch of groups."""
    rows = []
    for r in pdf.itertuples(index=False):
        n = float(r.n)
        mean = np.array([float(getattr(r, f"s{i}")) for i in range(DIM)]) / n
        cov = np.empty((DIM, DIM))
        for i in range(DIM):
            for j in range(i, DIM):
                cov[i, j] = cov[j, i] = float(getattr(r, f"p{i}{j}")) / n - mean[i] * mean[j]
        cov = CONSISTENCY * cov / SCALE**2 + np.diag(np.square(FLOOR))
        rows.append([r.lang, r.grp, *(mean / SCALE), *np.linalg.inv(cov).ravel()])
    return pd.DataFrame(rows, columns=["lang", "grp", *PARAMS])


PARAMS = [f"m{i}" for i in range(DIM)] + [f"c{i}{j}" for i in range(DIM) for j in range(DIM)]


def _fit(rows: DataFrame) -> DataFrame:
    sums = [F.sum(F.col(f"x{i}").cast("decimal(20,0)")).cast("double").alias(f"s{i}") for i in range(DIM)]
    sums += [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(24,0)")).cast("double").alias(f"p{i}{j}")
             for i in range(DIM) for j in range(i, DIM)]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    agg = rows.groupBy("lang", "grp").agg(F.count("*").alias("n"), *sums)
    schema = f"lang {kinds['lang']}, grp {kinds['grp']}, " + ", ".join(f"{p} double" for p in PARAMS)
    return agg.mapInPandas(lambda it: map(_estimate, it), schema)


def _start(rows: DataFrame) -> DataFrame:
    """Middle and length of the shortest half of every coordinate."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = 16                                              # of a histogram bin, in fixed-point units

    def shortest_half(pdf: pd.DataFrame) -> pd.DataFrame:
        params = {p: 0.0 for p in PARAMS}
        for i, part in pdf.groupby("i"):
            part = part.sort_values("bin")
            at, below = part["bin"].to_numpy(), np.r_[0, part["n"].cumsum().to_numpy()]
            half = (below[-1] + 1) // 2
            to = np.searchsorted(below, below[:-1] + half)  # first bin end that completes a half
            ok = to <= len(at)
            length = np.where(ok, at[np.minimum(to, len(at)) - 1] - at, np.iinfo(np.int64).max)
            k = int(length.argmin())
            scale = max((length[k] + 1) * width / SCALE / 1.35, FLOOR[i])
            params[f"m{i}"] = (at[k] + (length[k] + 1) / 2) * width / SCALE
            params[f"c{i}{i}"] = 1 / scale**2
        return pd.DataFrame([[pdf["lang"].iloc[0], pdf["grp"].iloc[0], *params.values()]], columns=["lang", "grp", *PARAMS])

    each = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.floor(F.col(f"x{i}") / width).alias("bin")) for i in range(DIM))))
    hist = rows.select("lang", "grp", each.alias("e")).groupBy("lang", "grp", "e.i", "e.bin").agg(F.count("*").alias("n"))
    schema = f"lang {kinds['lang']}, grp {kinds['grp']}, " + ", ".join(f"{p} double" for p in PARAMS)
    return hist.groupBy("lang", "grp").applyInPandas(shortest_half, schema)


def _distance(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of every row under its group's estimate."""
    p = params.withColumnsRenamed({"lang": "p_lang", "grp": "p_grp"})
    on = rows["lang"].eqNullSafe(p["p_lang"]) & rows["grp"].eqNullSafe(p["p_grp"])
    d = [F.col(f"x{i}") / F.lit(float(SCALE)) - F.col(f"m{i}") for i in range(DIM)]
    d2 = sum((d[i] * F.col(f"c{i}{j}") * d[j] for i in range(DIM) for j in range(DIM)), F.lit(0.0))
    return rows.join(p, on, "left").withColumn("d2", d2).drop("p_lang", "p_grp", *PARAMS)


def _bin(d2):
    """Fine logarithmic bin of a squared distance."""
    return F.floor(16 * F.log2(F.col(d2) + F.lit(2.0**-10))).cast("int")


def _support(dist: DataFrame) -> DataFrame:
    """Per group, the largest bin of the concentration set."""
    kinds = {f.name: f.dataType.simpleString() for f in dist.schema}

    def last_bin(pdf: pd.DataFrame) -> pd.DataFrame:
        b = pdf.sort_values("bin")
        need = math.ceil(SUPPORT * b["n"].sum())
        at = int(np.searchsorted(b["n"].cumsum().to_numpy(), need))
        return pd.DataFrame({"lang": b["lang"].iloc[:1].tolist(), "grp": b["grp"].iloc[:1].tolist(),
                             "last": [int(b["bin"].iloc[at])]})

    hist = dist.groupBy("lang", "grp", _bin("d2").alias("bin")).agg(F.count("*").alias("n"))
    return hist.groupBy("lang", "grp").applyInPandas(
        last_bin, f"lang {kinds['lang']}, grp {kinds['grp']}, last int")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    stats = statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    stats = saved(stats.select("*", *_vector()), "quality-stats")
    good = stats.where(~F.col("base_failed"))

    sizes = good.groupBy("lang", "source").agg(F.count("*").alias("size"))
    big = saved(sizes.where(F.col("size") >= MIN_GROUP).select(
        F.col("lang").alias("b_lang"), F.col("source").alias("b_source"), F.lit(True).alias("own")), "quality-groups")
    on = stats["lang"].eqNullSafe(F.col("b_lang")) & stats["source"].eqNullSafe(F.col("b_source"))
    own = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source")))   # null is not ''
    grp = F.when(F.col("own"), own).otherwise(F.lit("*"))
    rows = stats.join(sized(big, BROADCAST_GROUPS), on, "left").withColumn("grp", grp).drop("b_lang", "b_source", "own")
    good = rows.where(~F.col("base_failed"))
    pooled = good.groupBy("lang", "grp").agg(F.count("*").alias("size"))
    judged = pooled.where(F.col("size") >= MIN_GROUP).select("lang", "grp")

    params = saved(_start(good), "quality-fit")
    for _ in range(STEPS):
        dist = _distance(good, sized(params, BROADCAST_GROUPS))
        last = saved(_support(dist), "quality-support").withColumnsRenamed({"lang": "l_lang", "grp": "l_grp"})
        near = dist.join(sized(last, BROADCAST_GROUPS),
                         dist["lang"].eqNullSafe(F.col("l_lang")) & dist["grp"].eqNullSafe(F.col("l_grp")))
        params = saved(_fit(near.where(_bin("d2") <= F.col("last"))), "quality-fit")
    params = saved(params.join(judged.withColumnsRenamed({"lang": "j_lang", "grp": "j_grp"}),
                               F.col("lang").eqNullSafe(F.col("j_lang")) & (F.col("grp") == F.col("j_grp")),
                               "left_semi"), "quality-fit")

    out = _distance(rows, sized(params, BROADCAST_GROUPS))
    outlier = F.coalesce(F.col("d2") > F.lit(cutoff), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", (~F.col("base_failed") & ~outlier).alias("kept"),
                      F.col("d2").alias("distance"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass; a doc_id that occurs more than once passes
    only if all of its rows do."""
    bad = quality_rules(docs).where(~F.col("kept")).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
