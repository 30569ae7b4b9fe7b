"""Training-data operators against brute force, and their edge cases."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from histlake.llm import op1_mixing, op2_run_length_index, op3_topk_pivots, op4_packing, op5_line_dedup
from histlake.llm import op6_substring_dedup, op7_quality_rules, op8_quality_gam, op9_ngram_join, op10_url_filter
from histlake.llm.common import table
from histlake.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = DOCS + ", pos binary, doc_key long, m_at long, node long, component long, n_lines long, block int"


def frame(spark, texts, schema=DOCS, ids=None):
    rows = [(ids[i] if ids else i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    more = len(schema.split(",")) - 5
    return spark.createDataFrame([(*r, *[None] * more) for r in rows], schema)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts(rng):
    """Nulls, empties, white space, copies, long and very short texts."""
    base = [words(rng, 120) for _ in range(6)]
    lines = ["\n".join(words(rng, 9) for _ in range(8)) for _ in range(4)]
    return [None, "", " \n\t", "a", "a b c", *base, base[0], base[0] + " tail", *lines, lines[0], lines[1] + "\n" + lines[2],
            "é" * 70 + base[1], "x" * 300, "x" * 300, "x" * 299, words(rng, 30_000, 50_000), base[2][:200] + base[3][:200]]


@pytest.fixture(scope="module")
def texts():
    return odd_texts(random.Random(5))


# -- op1 ---------------------------------------------------------------------

def brute_schedule(counts, share):
    """Earliest deadline first over the first periods, slot by slot."""
    period, out = sum(share.values()), {}
    jobs = [(-(-(i + 1) * period // a), s, i, i * period // a) for s, a in share.items() for i in range(4 * a)]
    for slot in range(3 * period):
        ready = [j for j in jobs if j[3] <= slot]
        job = min(ready)
        jobs.remove(job)
        out[job[1], job[2]] = slot
    return {k: v for k, v in out.items() if k[1] < counts.get(k[0], 0)}


def test_schedule_is_earliest_deadline_first_and_within_one_block(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
                                   F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 == 0, "small").alias("source"),
                                   F.lit(1).cast("long").alias("n_chars"))
    weights = {"big": 5.0, "small": 2.0, "*": 1.0}
    out = op1_mixing.schedule(docs, weights, block_docs=8, period=16).toPandas()
    assert len(out) == 900 and out.doc_id.is_unique
    share = op1_mixing.shares(weights, 16)
    blocks = out.groupby(["mix_source", "block"]).slot.agg(["min", "max", "size"])
    assert (blocks["min"] == blocks["max"]).all() and (blocks["size"] <= 8).all()
    counts = out.groupby("mix_source").block.max().add(1).to_dict()
    want = brute_schedule(counts, share)
    got = {k: v for k, v in blocks["min"].to_dict().items() if k in want}
    assert got == want
    assert ((out.release <= out.slot) & (out.slot < out.deadline)).all()
    slots = sorted((v, k[0]) for k, v in blocks["min"].to_dict().items())
    done = Counter()
    horizon = min(counts[s] * 16 // share[s] for s in counts)      # until a source runs out
    for slot, s in slots:
        if slot < horizon:
            done[s] += 1
            assert all(abs(done[x] - (slot + 1) * share[x] / 16) < 1 for x in share)
    order = out.drop_duplicates(["mix_source", "block"]).sort_values("slot")
    assert order.position.tolist() == list(range(len(order)))
    places = out.sort_values(["mix_source", "block", "place"])
    assert places.groupby(["mix_source", "block"]).place.apply(lambda p: p.tolist() == list(range(len(p)))).all()


def test_mixed_keeps_all_rows_in_order(spark, texts):
    docs = frame(spark, texts, ODD)
    out = op1_mixing.mixed(docs, {"src0": 2.0, "src1": 1.0}, block_docs=2)
    assert out.columns == docs.columns
    order = {r.doc_id: (r.position, r.place) for r in op1_mixing.schedule(docs, {"src0": 2.0, "src1": 1.0}, block_docs=2).collect()}
    ids = [r.doc_id for r in out.collect()]
    assert sorted(ids) == list(range(len(texts))) and ids == sorted(ids, key=order.get)


def test_shares_are_whole_and_positive():
    for w in ({"a": 1.0}, {"a": 1e-9, "b": 1.0}, {f"s{i}": i + 1.0 for i in range(40)}):
        s = op1_mixing.shares(w, 64)
        assert sum(s.values()) == 64 and min(s.values()) >= 1
    with pytest.raises(ValueError):
        op1_mixing.shares({"a": 0.0})


def test_target_weights_are_held_over_many_periods(spark):
    total, many = 97, 20                                           # WEIGHTS add up to 97: one period
    counts = {("other" if s == "*" else s): int(w) * many for s, w in op1_mixing.WEIGHTS.items()}
    rows = [(i, "t", "en", s, 1) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    out = op1_mixing.schedule(spark.createDataFrame(rows, DOCS), op1_mixing.WEIGHTS, block_docs=1).toPandas()
    assert sorted(out.slot) == list(range(total * many)) == sorted(out.position)
    assert ((out.release <= out.slot) & (out.slot < out.deadline)).all()
    done = Counter()
    for at, s in enumerate(out.sort_values("slot").mix_source):
        done[s] += 1
        assert all(abs(done[x] - (at + 1) * w / total) < 1 for x, w in op1_mixing.WEIGHTS.items())


def test_weights_that_do_not_fit_a_period_are_refused(spark):
    assert op1_mixing.shares({"a": 1e-4, "b": 0.9999}) == {"a": 1, "b": 9999}
    assert op1_mixing.shares({"a": Fraction(1, 3), "b": Fraction(2, 3)}) == {"a": 1, "b": 2}
    docs = frame(spark, ["t"])
    for weights, period in (({"a": 1 / 3, "b": 1.0}, None), ({"a": 2.0, "*": 1.0}, 16), ({"a": float("inf")}, None)):
        with pytest.raises(ValueError):
            op1_mixing.schedule(docs, weights, period=period)


# -- op2 ---------------------------------------------------------------------

def brute_strings(rows):
    seen, out, by_id = set(), {}, defaultdict(list)
    for d, t in rows:
        by_id[d].append((t or "").encode())
    for d in sorted(by_id):
        own = set()
        for b in by_id[d]:
            cover = bytearray(len(b))
            for i in range(len(b) - 49):
                if b[i:i + 50] in seen:
                    cover[i:i + 50] = b"\1" * 50
                own.add(b[i:i + 50])
            kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
            spans = len(re.findall(b"\1+", bytes(cover)))
            out.setdefault(d, []).append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
        seen |= own
    return out


def test_strings_match_brute_force(spark, texts):
    rng = random.Random(9)
    passage = words(rng, 60)
    more = [*texts, *(f"{words(rng, rng.randrange(5, 40))} {passage[i:]} {words(rng, 20)}" for i in range(12)), "ab" * 200, "ab" * 60, "y" * 49]
    ids = [*range(1, len(more)), 3]                      # one doc_id twice
    out = op2_run_length_index.dedup_strings(frame(spark, more, ODD, ids)).collect()
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    want = brute_strings(zip(ids, more, strict=True))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}


def test_index_alone_matches_brute_force():
    rng = random.Random(3)
    core = "".join(rng.choice("ab") for _ in range(90)).encode()
    strings = [core[rng.randrange(20):60 + rng.randrange(30)] + rng.choice([b"", b"q"]) for _ in range(40)]
    owners = np.array([rng.randrange(9) for _ in strings])
    want = {(i, a) for i, s in enumerate(strings) for a in range(len(s) - 49)
            if any(owners[j] < owners[i] and s[a:a + 50] in t for j, t in enumerate(strings))}
    assert set(op2_run_length_index.repeats_in(strings, owners)) == want


def test_oversized_gram_group_is_split_exactly(monkeypatch):
    rng = random.Random(4)
    gram = b"the common gram 1234"
    strings = [bytes(rng.choice(b"xyz") for _ in range(30)) + gram + bytes(rng.choice(b"xyz") for _ in range(25)) for _ in range(20)]
    strings += [s[:70] + b"!!!" for s in strings[:8]]
    docs, offs = np.arange(len(strings)), [30] * len(strings)
    whole = sorted(op2_run_length_index.block_spans(strings, offs, docs, np.zeros(len(strings), np.int64)))
    monkeypatch.setattr(op2_run_length_index, "INDEX_BYTES", 700)
    assert sorted(op2_run_length_index.block_spans(strings, offs, docs, np.zeros(len(strings), np.int64))) == whole and whole


def test_only_repeated_anchors_are_marked():
    import pyarrow as pa

    rng = random.Random(8)
    shared = rng.randbytes(3000)
    texts = [rng.randbytes(6000) + shared, rng.randbytes(4000), shared[:1500] + b"!" + shared[1500:] + rng.randbytes(5000), b""]
    parts = [op2_run_length_index.Keys([t], 0) for t in texts]             # one batch each, one block of hashes
    told = op2_run_length_index.answer(pa.table({"batch": range(4), "block": pa.array([0] * 4, pa.int32()), "key": [k.key.tobytes() for k in parts],
                                                 "many": [np.packbits(np.zeros(len(k.key), bool)).tobytes() for k in parts]})).to_pylist()
    assert [a["batch"] for a in told] == [0, 2]
    for a, at, size in ((told[0], 6000, 3000), (told[1], 0, 3001)):
        again, varied = parts[a["batch"]].flags([a])
        _, place, _, first, last, _ = parts[a["batch"]].found
        assert (again <= ((place >= at) & (place + 20 <= at + size))).all()  # nothing but what is shared
        shares = np.bincount(parts[a["batch"]].key >> np.uint64(61), minlength=8)
        assert shares.max() < 2 * shares.mean()                              # anchors are minima; their keys are dealt evenly
        covered = {x for lo, hi in zip(first[again], last[again] + 50, strict=True) for x in range(lo, hi)}
        assert covered >= set(range(at, at + 1500)) | set(range(at + size - 1500, at + size))
        assert varied.any() and (varied <= again).all() and varied.sum() < again.sum()


def test_spans_of_one_document_are_joined():
    got = op2_run_length_index.joined_spans(*(np.array(c, np.uint32) for c in ([3, 1, 3, 3, 1], [90, 5, 0, 10, 4], [95, 6, 80, 20, 5])))
    assert [x.tolist() for x in got] == [[1, 3, 3], [4, 0, 90], [6, 80, 95]]
    assert [len(x) for x in op2_run_length_index.joined_spans(*[np.zeros(0, np.uint32)] * 3)] == [0, 0, 0]


def test_lots_keep_a_gram_together(monkeypatch):
    rng = random.Random(6)
    grams = [f"gram {i:04d} with 20 by".encode()[:20] for i in range(40)]
    texts, raw, at = [], b"", []
    for _ in range(400):
        g, before = rng.choice(grams), rng.randrange(31)
        texts.append(g)
        at.append(len(raw) + before)
        raw += b"." * before + g + b"." * (50 - before)
    assert [len(x) for x in op2_run_length_index.gram_lots(raw, np.array(at))] == [400]
    monkeypatch.setattr(op2_run_length_index, "LOT_BYTES", 5000)
    lots = [x.tolist() for x in op2_run_length_index.gram_lots(raw, np.array(at))]
    assert sorted(i for x in lots for i in x) == list(range(400)) and len(lots) > 1
    assert sum(len({texts[i] for i in x}) for x in lots) == len(set(texts))


# -- op3 ---------------------------------------------------------------------

def test_top_k_edges(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]                     # ties
    rows += [(400, None), (401, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (402, [float("nan")] * 6), (450, [float("inf")] * 6),
             (None, rows[0][1]), (500, [1.0, 2.0]), (501, [0.5, 0.5]), (550, []), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("d", F.lit("x"))
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, qv in ok:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in ok if i != q and len(v) == len(qv))
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    got = op3_topk_pivots.top_k(df, F.col("vec_id") % 50 == 0, query_block=3, vector_block=64)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_of_large_components(spark):
    a, b = float(1 << 21), float(1 << 22)
    rows = [(0, [1.0, 1.0]), (1, [a, 0.0]), (2, [b, 0.0]), (3, [3e38, -3e38]), (4, [-a, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in op3_topk_pivots.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1 << 38), (0, 2, 1, 1 << 37), (0, 3, 3, 0), (0, 4, 4, 256 * (128 - (1 << 29)))]
    most = [tuple(r) for r in op3_topk_pivots.top_k(df, F.col("vec_id") == 3).orderBy("rank").collect()]
    edge = (1 << 63) - 1
    assert most == [(3, 1, 1, edge), (3, 2, 2, edge), (3, 3, 0, 0), (3, 4, 4, -edge)]


def test_pivots_stop_early():
    import pandas as pd

    rng = np.random.default_rng(0)
    x = np.vstack([rng.integers(-5, 5, (2000, 8)) - 200, rng.integers(-5, 5, (200, 8)) + 200])
    pivots = x[::100]
    d = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    v = pd.DataFrame({"vec_id": range(len(x)), "v": list(x), "d": list(d)})
    found, scored = op3_topk_pivots.block_top(v.tail(10), v, 5)
    assert scored < 10 * 1000 and len(found) == 50


def pivot_frame(x, pivots):
    import pandas as pd

    x = np.asarray(x, float)
    return pd.DataFrame({"vec_id": range(len(x)), "v": list(x), "d": list(op3_topk_pivots.distances(x, pivots))})


def best_by_hand(x, queries, k=5):
    exact = [[int(c) for c in v] for v in x]
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(exact[q], v, strict=True)), i) for i, v in enumerate(exact) if i != q)
        yield from ((q, i, -s) for s, i in scores[:k])


def test_a_block_scores_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(1)
    x = rng.integers(-60, 60, (6000, 16))
    x[3000:3900] = x[40]                                                   # copies: ties everywhere
    v = pivot_frame(x, x[:32].tolist())
    tracemalloc.start()
    found, scored = op3_topk_pivots.block_top(v[::12], v, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 << 20                                                 # a score of each pair alone takes 24 MB
    few = {0, 12, 36, 3000, 3600, 5988}
    assert sorted(r for r in found if r[0] in few) == sorted(best_by_hand(x.tolist(), sorted(few)))


def test_far_pivots_do_not_cut_off_the_best():
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (800, 8))
    far = (rng.integers(1, 9, (6, 8)) * 10.0 ** 18).tolist()               # distances to these hold no units
    v = pivot_frame(x, far)
    found, _ = op3_topk_pivots.block_top(v[::100], v, 5)
    assert sorted(found) == sorted(best_by_hand(x.tolist(), range(0, 800, 100)))


# -- op4 ---------------------------------------------------------------------

def check_pieces(rows, texts_by_id):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts_by_id)
    for d, parts in by_doc.items():
        ids = np.array([*t.encode(texts_by_id[d] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    return padding / total


def test_packing_is_whole_and_tight(spark, texts):
    strange = ["İstanbul ΟΔΟΣ é e\u0301 <|endoftext|>x a\u00a0b\u2003c\x1cd \u200b 's 12'll", "<|startoftext|> <| |>", "\u0301"]
    df = frame(spark, [*texts, *strange], ODD)
    rows = [r.asDict() for r in op4_packing.pack(df, tokenizer_path()).collect()]
    check_pieces(rows, dict(enumerate([*texts, *strange])))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    docs = table(spark, SF, "documents")
    rows = [r.asDict() for r in op4_packing.pack(docs, tokenizer_path(), with_ids=False).collect()]
    assert check_pieces(rows, {r.doc_id: r.text for r in docs.collect()}) < 0.02


def test_cuts_are_the_cheapest():
    rng = random.Random(8)
    for _ in range(30):
        points = [0, *sorted(rng.sample(range(1, 60), 14)), 60]
        costs = [0, *(rng.choice([0, 2, 9]) for _ in range(14)), 0]
        best = [0] + [10**9] * (len(points) - 1)
        for j in range(1, len(points)):
            for i in range(j):
                if points[j] - points[i] <= 16:
                    best[j] = min(best[j], best[i] + 16 - points[j] + points[i] + costs[j])
        if max(b - a for a, b in zip(points, points[1:], strict=False)) > 16:
            continue
        cuts = op4_packing.best_cuts(points, costs, 16)
        paid = sum(16 - (b - a) + costs[points.index(b)] for a, b in zip(cuts, cuts[1:], strict=False))
        assert paid == best[-1] and all(b - a <= 16 for a, b in zip(cuts, cuts[1:], strict=False))


def test_full_word_table_stays_exact(spark, texts):
    ids = op4_packing.Ids(tokenizer_path(), limit=10)
    for part in (texts[:9], texts[9:], texts):
        whole = [t or "" for t in part]
        assert ids.of(whole) == [ids.ids(t).tobytes() for t in whole]
    assert len(ids) < 1000


# -- op5, op6 ----------------------------------------------------------------

def brute_lines(rows, window=op5_line_dedup.WINDOW):
    first, per = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        lines = [x for x in (t or "").encode().split(b"\n") if x.split()]
        gone = set()
        for i in range(len(lines) - window + 1):
            key = tuple(x.strip() for x in lines[i:i + window])
            if first.setdefault(key, (d, i)) != (d, i):
                gone.update(range(i, i + window))
        per[d] = (len(lines), len(gone))
    return per


def test_line_runs_match_brute_force(spark, texts):
    rng = random.Random(1)
    pool = [words(rng, 6) for _ in range(12)]
    more = [*texts, *("\n".join(rng.choice([*pool, "", "  "]) for _ in range(14)) for _ in range(30))]
    out = {r.doc_id: r for r in op5_line_dedup.dedup_lines(frame(spark, more, ODD), min_words=None).collect()}
    assert {d: (r.n_lines, r.n_removed) for d, r in out.items()} == brute_lines(list(enumerate(more)))
    for d, r in out.items():
        assert (r.text is None) == (more[d] is None)
        assert hashlib.sha256((r.text or "").encode()).hexdigest() == r.kept_sha256
        assert sum(x.end - x.start for x in r.runs) == r.n_removed


def brute_passages(rows, min_words, longest=None):
    """Every run of any length (or up to ``longest`` lines) that has 3 lines or enough words, against all earlier ones."""
    first, per = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        lines = [x.strip() for x in (t or "").encode().split(b"\n") if x.split()]
        gone = set()
        for i in range(len(lines)):
            for j in range(i + 1, min(len(lines), i + (longest or len(lines))) + 1):
                run = tuple(lines[i:j])
                if len(run) >= 3 or sum(len(x.split()) for x in run) >= min_words:
                    if first.setdefault(run, (d, i)) != (d, i):
                        gone.update(range(i, j))
        per[d] = [i in gone for i in range(len(lines))]
    return per


@pytest.mark.parametrize("hot", [op5_line_dedup.HOT_LEAST, 0, 6])    # 0: every line is hot, 6: some
def test_passages_match_brute_force(spark, texts, monkeypatch, hot):
    monkeypatch.setattr(op5_line_dedup, "HOT_LEAST", hot)
    monkeypatch.setattr(op5_line_dedup, "HOT", 0 if hot < 100 else 64)
    rng = random.Random(8)
    pool = [words(rng, n) for n in (1, 1, 2, 2, 3, 4, 5, 7, 8, 9, 60)]
    more = [*texts, *("\n".join(rng.choice([*pool, words(rng, rng.randint(1, 9)), "", "  "]) for _ in range(rng.randint(1, 14)))
                      for _ in range(80))]
    want = brute_passages(list(enumerate(more)), 8)
    for r in op5_line_dedup.dedup_lines(frame(spark, more, ODD), min_words=8).collect():
        gone = {i for x in r.runs for i in range(x.start, x.end)}
        assert [i in gone for i in range(r.n_lines)] == want[r.doc_id], more[r.doc_id]
        assert r.n_removed == len(gone)
        assert hashlib.sha256((r.text or "").encode()).hexdigest() == r.kept_sha256


def test_long_passage_on_one_or_two_lines_goes(spark):
    rng = random.Random(9)
    long, two = words(rng, 60), words(rng, 30) + "\n" + words(rng, 30)
    docs = [f"head a\n{long}\ntail a", f"head b\n{long}\ntail b", long, f"x\n{two}\ny", two, "few words", "few words"]
    out = {r.doc_id: r.text for r in op5_line_dedup.dedup_lines(frame(spark, docs), min_words=8).collect()}
    assert [out[i] for i in range(7)] == [docs[0], "head b\ntail b", "", docs[3], "", "few words", "few words"]


def test_units_match_brute_force(spark, texts):
    rng = random.Random(6)
    pool = [words(rng, 10) + "." for _ in range(10)]
    more = [*texts, *("\n".join(" ".join(rng.choices(pool, k=3)) for _ in range(3)) for _ in range(20)), pool[0].upper()]
    seen, want = set(), {}
    for d, t in enumerate(more):
        raw, gone = (t or "").encode(), bytearray(len((t or "").encode()))
        for a, b, norm in op6_substring_dedup.units(raw):
            if norm in seen:
                gone[a:b] = b"\1" * (b - a)
            seen.add(norm)
        want[d] = hashlib.sha256(bytes(x for x, g in zip(raw, gone, strict=True) if not g)).hexdigest()
    out = op6_substring_dedup.dedup_units(frame(spark, more, ODD)).collect()
    assert {r.doc_id: r.kept_sha256 for r in out} == want
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == r.kept_sha256 for r in out)
    assert out[0].asDict().keys() >= {"n_lines", "removed", "lang"}


# -- op7 ---------------------------------------------------------------------

def crc_collision():
    """Two different texts of equal CRC-32, found by search."""
    seen = {}
    for i in range(400_000):
        t = f"line {hashlib.sha1(str(i).encode()).hexdigest()} with a few more words in it. "
        c = zlib.crc32(t.encode())
        if c in seen:
            return seen[c], t
        seen[c] = t
    raise AssertionError("no collision")


def test_texts_of_equal_crc_without_ids_are_told_apart(spark):
    a, b = crc_collision()
    long = "one two three four five six seven eight nine ten"
    texts = [f"{long}\n{a}", f"{long}\n{b}", f"{long}\n{b}"]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    out = [r["text"] for r in op6_substring_dedup.dedup_units(df).collect()]
    assert sum(a.strip() in t for t in out) == 1 and sum(b.strip() in t for t in out) >= 1
    assert sum(long in t for t in out) >= 1


def test_counts_match_brute_force(spark, texts):
    strange = ["a b c a b c a b c", "x\n\nx\n x\nx", "#* $é <|>", "a\u00a0b\u2003c\x1cd e\vf", "q q q q"]
    more = [*texts, *strange]
    out = {r.doc_id: r for r in op7_quality_rules.quality_rules(frame(spark, more, ODD)).collect()}
    for d, t in enumerate(more):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        many = Counter(grams)
        rep = len({i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)})
        r = out[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep), t[:50]
        assert r.base_failed == (len(w) < 50 or 100 * rep > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_outliers_are_found_and_clean_documents_stay(spark):
    out = QUERIES["op7_quality_outliers"](spark, "/root/testdata/sf0.01").toPandas()
    labels = table(spark, "/root/testdata/sf0.01", "labels").toPandas()
    m = out.merge(labels, on="doc_id")
    m = m[~m.base_failed]
    assert m[m.quality == 1].kept.mean() > 0.995
    assert m[m.quality == 0].kept.mean() < 0.1


def test_robust_estimate_ignores_a_third_of_junk(spark):
    rng = random.Random(0)
    good = [words(rng, rng.randrange(60, 400)) for _ in range(160)]
    junk = [" ".join(f"{w}###" for w in words(rng, 80).split()) for _ in range(70)]
    rows = [(i, t, None, "s", 0) for i, t in enumerate(good + junk)]
    out = op7_quality_rules.keep_good(spark.createDataFrame(rows, DOCS))
    kept = {r.doc_id for r in out.collect()}
    assert len(kept & set(range(160))) >= 158 and not kept & set(range(160, 230))


# -- op8 ---------------------------------------------------------------------

def test_gam_predicts_held_out_labels(spark):
    out = QUERIES["op8_quality_gam"](spark, "/root/testdata/sf0.1").toPandas()
    labels = table(spark, "/root/testdata/sf0.1", "labels").toPandas()
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    m = out[out.held_out].merge(labels, on="doc_id")
    assert (m.predicted == m.quality).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_gam_edges(spark, texts):
    docs = frame(spark, texts, ODD)
    for labels in ([], [(1, 1, 0), (2, 1, 0), (3, None, 0)], [(i, i % 2, 0) for i in range(len(texts))]):
        lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        out = op8_quality_gam.quality_scores(docs, lab).toPandas()
        assert len(out) == len(texts) and out.score.between(0, 1).all()


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    p = op8_quality_gam.Gam(pair_rounds=60).fit(x[:2000], y[:2000]).score(x[2000:])
    assert ((p > 0.5) == (y[2000:] > 0)).mean() > 0.9


# -- op9 ---------------------------------------------------------------------

def brute_components(rows):
    sets, parent = {}, {}
    for d, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        parent[d] = d

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(sets[d]), top(d)) for d in ids}


def near(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_similar_groups_match_brute_force(spark, texts):
    rng = random.Random(7)
    passage = words(rng, 80)
    base = words(rng, 150, 4000)
    more = [*texts, "A B c d", "a b C d", "A a a a a a a", "a a a a a"]
    more += [near(rng, base, rng.randrange(0, 8)) for _ in range(60)]                   # around the threshold
    more += [f"{passage} {words(rng, rng.randrange(5, 60), 9000)}" for _ in range(40)]  # a shared passage
    more += [words(rng, n, 3) for n in range(3, 40)]
    ids = rng.sample(range(10_000), len(more))
    got = op9_ngram_join.similar_groups(frame(spark, more, ODD, ids)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(zip(ids, more, strict=True))
    kept = {r.doc_id for r in op9_ngram_join.keep_one_each(frame(spark, more, ODD, ids)).collect()}
    assert kept == {r.component_id for r in got}


@pytest.mark.parametrize("twice", [7, None])
def test_id_with_a_copy_and_another_text_joins_both(spark, twice):
    rng = random.Random(12)
    a, b = words(rng, 80, 5000), words(rng, 80, 5000)
    rows = [(3, a), (twice, a), (twice, b), (4, near(rng, b, 1)), (5, words(rng, 80, 5000))]
    parts = [frame(spark, [t], ids=[d]) for d, t in rows]      # equal rows in different batches
    got = op9_ngram_join.similar_groups(functools.reduce(lambda x, y: x.union(y), parts)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == sorted((d or 0, 5 if d == 5 else 3) for d, _ in rows)


def test_large_group_of_near_copies_joins_by_drawn_rows(spark, monkeypatch):
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(90)]
    texts = []
    for _ in range(150):                     # two changed words each: pairs are near 0.75 similar, on either side
        t = list(base)
        for i in rng.sample(range(90), 1 + rng.randrange(2)):
            t[i] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(t))
    monkeypatch.setattr(op9_ngram_join, "PAIRS_PER_ROW", 0)      # a round if any pair is left
    monkeypatch.setattr(op9_ngram_join, "STAR_ROUNDS", 2)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_ngram_join.similar_groups(frame(spark, texts)).collect()}
    assert out == brute_components(list(enumerate(texts)))


def test_near_copies_are_compared_with_their_template_not_with_each_other(spark, monkeypatch):
    rng = random.Random(13)
    base = [f"w{i}" for i in range(404)]
    texts = []
    for _ in range(70):                      # 0.75 similar to the template, not to each other
        t = list(base)
        for i in range(rng.randrange(10, 30), 400, 37):
            t[i] = f"x{rng.randrange(10 ** 9)}"
        texts.append(" ".join(t))
    texts.append(" ".join(base))             # the template has the largest id
    compared = []
    linked = op9_ngram_join._linked
    monkeypatch.setattr(op9_ngram_join, "_linked", lambda pairs, *a: (compared.append(pairs.count()), linked(pairs, *a))[1])
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_ngram_join.similar_groups(frame(spark, texts)).collect()}
    assert out == brute_components(list(enumerate(texts)))
    assert {c for _, c in out.values()} == {0} and sum(compared) < 3 * len(texts)


def test_sketches_keep_every_link():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 17, 64, 300, 2000):
        for both in range(0, n + 1, max(1, n // 40)):
            m = n + int(rng.integers(0, n))
            pool = rng.integers(0, 2 ** 63, n + m, dtype=np.uint64)
            x, y = np.unique(pool[:n]), np.unique(pool[n - both:][:m])
            common = len(np.intersect1d(x, y))
            if common and 100 * common >= 75 * (len(x) + len(y) - common):
                assert op9_ngram_join.may_be_linked(op9_ngram_join.sketch(x), op9_ngram_join.sketch(y))
            elif n >= 300 and common < 0.6 * n:
                assert not op9_ngram_join.may_be_linked(op9_ngram_join.sketch(x), op9_ngram_join.sketch(y))
    assert not op9_ngram_join.may_be_linked(op9_ngram_join.sketch(x), op9_ngram_join.sketch(x[:0]))


def test_pairs_of_common_passages_are_not_compared_by_full_rows(spark, monkeypatch):
    rng = random.Random(14)
    passages = [words(rng, 60, 9000) for _ in range(8)]
    # four passages of eight each: 560 pairs share three of them and are 0.6 similar
    texts = [" ".join(passages[i] for i in four) for four in itertools.combinations(range(8), 4)]
    texts += [near(rng, texts[0], 1), near(rng, texts[-1], 1), texts[5]]
    compared = []
    linked = op9_ngram_join._linked
    monkeypatch.setattr(op9_ngram_join, "_linked", lambda pairs, *a: (compared.append(pairs.count()), linked(pairs, *a))[1])
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in op9_ngram_join.similar_groups(frame(spark, texts)).collect()}
    assert out == brute_components(list(enumerate(texts)))
    assert sum(compared) < 3 * len(texts)


def test_repeated_and_null_ids_share_a_node(spark):
    rng = random.Random(11)
    a, b = words(rng, 40, 999), words(rng, 40, 999)
    got = op9_ngram_join.similar_groups(frame(spark, [a, b, a, b, "z"], ids=[5, 5, 7, None, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got)[2:] == [(5, 5), (5, 5), (7, 5)]
    assert len(got) == 5


# -- op10 --------------------------------------------------------------------

URLS = [None, "", "nothing", "http://a.org", "http://a.org/x", "HTTP://A.EXAMPLE.ORG/es/1?q=/en/1", "http://example.org/en/1",
        "http://example.org/en/19", "http://example.org/en/2", "http://xexample.org/es/", "https://b.com/fr/", "https://b.com/de/x#y",
        "https://b.com?de/", "x://spam.net/", "x://www.spam.net", "x://spam.net/page", "x://notspam.net", "x://path.net/bad",
        "x://path.net/bad/more", "x://a://b.com/de/", "x://SPAM.net:80/", "x://ß.net/\nq", "x://a..net/"]


@pytest.mark.parametrize("bound", [100, 1])
def test_urls(spark, bound):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("entry", F.lit("x"))
    blocked = spark.createDataFrame([("spam.net",), ("path.net/bad",), ("spam.net",), (None,), ("",), ("ß.net",)], "entry string")
    got = {r.page_id: r for r in op10_url_filter.judge_urls(pages, blocked, max_entries=bound).collect()}
    for i, url in enumerate(URLS):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(str.maketrans(op10_url_filter.UPPER, op10_url_filter.LOWER)), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for v, h, p in op10_url_filter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        listed = any(x in ("spam.net", "path.net/bad", "ß.net") for x in op10_url_filter.probes(host, path))
        want = (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "block" if listed else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want, url


def test_large_list_array_and_join_agree(spark):
    pages = table(spark, SF, "pages")
    own = op10_url_filter.host_and_path(pages).select("host", "path").distinct().collect()
    some = [r.host for r in own[::3]] + [r.host + r.path for r in own[1::3]]
    listed = spark.range(300_000).select(F.format_string("h%d.example.com/p", "id").alias("entry")).union(
        spark.createDataFrame([(e,) for e in some], "entry string"))
    array = op10_url_filter.judge_urls(pages, listed, rules=())
    join = op10_url_filter.judge_urls(pages, listed, rules=(), max_entries=1)
    got = sorted(map(tuple, array.select("page_id", "host", "path", "verdict").collect()))
    assert got == sorted(map(tuple, join.select("page_id", "host", "path", "verdict").collect()))
    assert {r[3] for r in got} == {"allow", "block"}


def test_collisions_are_told_apart():
    a = op10_url_filter.DigestArray(op10_url_filter.DigestArray.pack([b"one", b"two"]))
    k = np.array([a.keys[0]] * 2, np.uint64)
    assert a.contains([a.entry(0), b"other"], k).tolist() == [True, False]
    assert not op10_url_filter.DigestArray(op10_url_filter.DigestArray.pack([])).contains([b"x"]).any()


# -- empty tables ------------------------------------------------------------

def test_empty_tables(spark):
    docs = spark.createDataFrame([], ODD)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (op1_mixing.schedule(docs, op1_mixing.WEIGHTS), op1_mixing.mixed(docs), op2_run_length_index.dedup_strings(docs),
                op4_packing.pack(docs, tokenizer_path()), op5_line_dedup.dedup_lines(docs), op6_substring_dedup.dedup_units(docs),
                op7_quality_rules.quality_rules(docs), op7_quality_rules.keep_good(docs), op8_quality_gam.quality_scores(docs, labels),
                op9_ngram_join.similar_groups(docs), op9_ngram_join.keep_one_each(docs),
                op3_topk_pivots.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)),
                op10_url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "entry string"))):
        assert out.count() == 0


def test_packing_looks_up_only_the_chunks_of_a_batch():
    class Known(op4_packing.Ids):
        def keys(self):
            raise AssertionError("all known chunks are gone through")

    ids = Known(tokenizer_path(), limit=8)
    texts = ["alpha beta, alpha\nété! x1-y2 ###", "", "a\x1cb beta,", "gamma delta epsilon zeta eta theta", "alpha iota kappa"]
    for part in (texts, texts[::-1], ["lambda mu alpha"], ["mu nu", *texts]):        # known, new and beyond the limit
        assert ids.of(part) == [ids.ids(t).tobytes() for t in part]
