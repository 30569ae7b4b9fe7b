"""Mixing of sources to target weights by Pfair scheduling.

The documents of a source are put in a seeded order and dealt into blocks of
``block_docs``.  With weight w = a / L (a and L whole, the a of all sources
adding up to L) block i of a source is released at slot floor(i / w) and due
by slot ceil((i + 1) / w).  One block runs per slot, the released block with
the earliest deadline first.  On one processor this meets every deadline, so
after any number of slots a source is less than one block away from its
share.

The schedule repeats every L slots with exactly a blocks of each source, so
one period is scheduled and every block computes its slot from its number:
slot = (i div a) * L + period_slot(i mod a).  L is the common denominator of
the weights, taken as exact fractions (a float counts as the decimal it
prints), so the shares are the weights themselves and the deviation stays
below one block however long the input is.  Weights with a common denominator
above ``LONGEST`` are refused, not rounded.  No schedule over all blocks is
ever built.  A source that has run out leaves
its slots empty; ``position`` counts the filled slots before a block in closed
form, so all documents are kept.

Sources without a target weight (null ones too) take part as one further
source, ``REST``.  Repeated rows and ties are ordered by their columns; a
document without text is mixed like any other, a null or repeated doc_id too.
Empty input gives an empty result.  Other columns are ignored by the schedule
and kept by ``mixed``, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histlake.llm.common import prepare, saved

LONGEST = 1 << 16            # slots of the longest period that is scheduled
BLOCK_DOCS = 32
BUCKET_ROWS = 1024           # rows of the largest source that one ranking bucket expects
REST = "*"
#: Target weights of the registered query: the one large source is held back.
WEIGHTS = {"src0": 20.0} | {f"src{i}": 4.0 for i in range(1, 20)} | {REST: 1.0}


def exact_shares(weights: dict[str, float | Fraction]) -> dict[str, int]:
    """Slots per period in exactly the proportions of the weights: the
    smallest whole numbers that have them."""
    if not weights or not all(0 < w < math.inf for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    parts = {s: Fraction(repr(float(w))) if isinstance(w, float) else Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in parts.values()))
    whole = {s: int(w * scale) for s, w in parts.items()}
    common = math.gcd(*whole.values())
    got = {s: a // common for s, a in whole.items()}
    if sum(got.values()) > LONGEST:
        raise ValueError(f"weights repeat after {sum(got.values())} slots only, more than {LONGEST}: give them a smaller common denominator")
    return got


def shares(weights: dict[str, float], period: int | None = None) -> dict[str, int]:
    """Whole slots per period, in exactly the proportions of the weights.  In
    a given period they are rounded, at least one each, by largest remainder;
    no schedule is built on rounded ones."""
    if period is None:
        return exact_shares(weights)
    total = sum(weights.values())
    if not weights or min(weights.values()) <= 0 or len(weights) > period:
        raise ValueError("weights must be positive and at most one per slot of a period")
    exact = {s: w * period / total for s, w in weights.items()}
    got = {s: max(1, int(x)) for s, x in exact.items()}
    while (gap := period - sum(got.values())) != 0:
        step = 1 if gap > 0 else -1
        free = [s for s in got if got[s] + step >= 1]
        s = max(free, key=lambda s: (step * (exact[s] - got[s]), s))
        got[s] += step
    return got


def fitted(weights: dict[str, float | Fraction], period: int | None) -> dict[str, int]:
    """Exact slots per period; a period other than the shortest must be a
    multiple of it."""
    got = exact_shares(weights)
    times, rest = divmod(period or sum(got.values()), sum(got.values()))
    if rest or not times:
        raise ValueError(f"a period of {period} slots cannot hold the weights exactly, multiples of {sum(got.values())} can")
    return {s: a * times for s, a in got.items()}


def one_period(share: dict[str, int]) -> list[tuple[str, int]]:
    """(source, block number) by slot, earliest deadline first."""
    period = sum(share.values())
    due = lambda a, i: -(-(i + 1) * period // a)
    coming: dict[int, list] = {}
    for s, a in share.items():
        for i in range(a):
            coming.setdefault(i * period // a, []).append((due(a, i), s, i))
    ready, out = [], []
    for slot in range(period):
        for job in coming.get(slot, ()):
            heapq.heappush(ready, job)
        deadline, s, i = heapq.heappop(ready)
        assert slot < deadline
        out.append((s, i))
    return out


def _numbered(docs: DataFrame, seed: int) -> DataFrame:
    """Adds ``mix_source`` and ``nth``, the rank of a row in its source's seeded order.

    Ranks come from hash buckets of bounded size with the counts of the
    buckets before them, so a source with a third of all rows is ranked by
    many tasks."""
    sizes = [r["n"] for r in docs.groupBy("mix_source").agg(F.count("*").alias("n")).collect()]
    bits = max(2, (max(sizes, default=1) // BUCKET_ROWS).bit_length())
    low = bits // 2
    top = F.shiftrightunsigned("mix_hash", 64 - bits)
    rows = docs.withColumn("mix_bucket", top.cast("long"))
    # counts before a bucket: coarse buckets first, then the fine ones inside
    fine = saved(rows.groupBy("mix_source", "mix_bucket").agg(F.count("*").alias("n")), "mix-buckets")
    fine = fine.withColumn("coarse", F.shiftright("mix_bucket", low))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    coarse = fine.groupBy("mix_source", "coarse").agg(F.sum("n").alias("cn")).withColumn(
        "cbase", F.coalesce(F.sum("cn").over(before.partitionBy("mix_source").orderBy("coarse")), F.lit(0)))
    base = fine.withColumn("fbase", F.coalesce(
        F.sum("n").over(before.partitionBy("mix_source", "coarse").orderBy("mix_bucket")), F.lit(0)))
    base = base.join(coarse.drop("cn"), ["mix_source", "coarse"]).select(
        F.col("mix_source").alias("b_source"), F.col("mix_bucket").alias("b_bucket"), (F.col("fbase") + F.col("cbase")).alias("base"))
    inner = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_hash", "mix_tie")
    ranked = rows.withColumn("rn", F.row_number().over(inner))
    on = (F.col("mix_source") == F.col("b_source")) & (F.col("mix_bucket") == F.col("b_bucket"))
    return ranked.join(base, on).withColumn("nth", F.col("base") + F.col("rn") - 1).drop(
        "b_source", "b_bucket", "base", "rn", "mix_bucket")


def schedule(docs: DataFrame, weights: dict[str, float], block_docs: int = BLOCK_DOCS,
             period: int | None = None, seed: int = 1) -> DataFrame:
    """doc_id with its source's block, the block's release, deadline and slot,
    and the document's place in the mixed order (``position``: block,
    ``place``: document in the block)."""
    spark = prepare(docs.sparkSession)
    named: Column = F.when(F.col("source").isin([s for s in weights if s != REST]), F.col("source")).otherwise(F.lit(REST))
    share = fitted(weights if REST in weights else {**weights, REST: min(weights.values())}, period)
    period = sum(share.values())
    keys = [c for c in ("doc_id", "lang", "source", "n_chars") if c in docs.columns]
    slim = docs.select("doc_id", "source", named.alias("mix_source"),
                       F.xxhash64(F.lit(seed), *keys).alias("mix_hash"), F.struct(*keys).alias("mix_tie"))
    rows = _numbered(slim, seed).drop("mix_hash", "mix_tie").withColumn("block", F.floor(F.col("nth") / block_docs))

    table = one_period(share)
    slots = pd.DataFrame([(s, i, at) for at, (s, i) in enumerate(table)], columns=["t_source", "t_block", "t_slot"])
    slots["share"] = slots["t_source"].map(share)
    plan = F.broadcast(spark.createDataFrame(slots))           # one period: at most LONGEST rows
    a = F.create_map(*[x for s, n in share.items() for x in (F.lit(s), F.lit(n))])[F.col("mix_source")]
    on = (F.col("mix_source") == F.col("t_source")) & (F.pmod("block", a) == F.col("t_block"))
    turn = F.floor(F.col("block") / F.col("share"))
    placed = rows.join(plan, on).select(
        "doc_id", "source", "mix_source", "block", (F.col("nth") % block_docs).cast("int").alias("place"),
        F.floor(F.col("block") * period / F.col("share")).alias("release"),
        F.ceil((F.col("block") + 1) * period / F.col("share")).alias("deadline"),
        (turn * period + F.col("t_slot")).alias("slot"))

    # filled slots before a slot: for every source, the smaller of its blocks and its slots before
    sizes = {r["mix_source"]: -(-r["n"] // block_docs)
             for r in slim.groupBy("mix_source").agg(F.count("*").alias("n")).collect()}
    prefix = {s: [0] for s in share}
    for s, _ in table:
        for t in share:
            prefix[t].append(prefix[t][-1] + (t == s))
    at = pd.DataFrame([(i, [prefix[s][i] for s in share]) for i in range(period)], columns=["p_slot", "p_counts"])
    at = F.broadcast(spark.createDataFrame(at))
    turns = F.floor(F.col("slot") / period)
    filled = sum((F.least(F.lit(sizes.get(s, 0)), turns * n + F.col("p_counts")[i])
                  for i, (s, n) in enumerate(share.items())), F.lit(0))
    return placed.join(at, F.pmod("slot", F.lit(period)) == F.col("p_slot")).select(
        *placed.columns, filled.cast("long").alias("position"))


def mixed(docs: DataFrame, weights: dict[str, float] = WEIGHTS, **options) -> DataFrame:
    """All documents, stored order = mixed order (range-partitioned, sorted)."""
    order = saved(schedule(docs, weights, **options).select(
        F.col("doc_id").alias("__llm_id"), "position", "place"), "mix-order")
    # a repeated doc_id takes its first place
    order = order.groupBy("__llm_id").agg(F.min(F.struct("position", "place")).alias("__llm_at"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = docs.join(order, docs["doc_id"].eqNullSafe(order["__llm_id"]))
    return out.repartitionByRange(parts, "__llm_at").sortWithinPartitions("__llm_at").select(*docs.columns)
