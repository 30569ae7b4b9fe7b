"""Line dedup by winnowing over line hashes.

The lines that hold a word form a document's hash sequence.  Its windows are
the shortest runs that count: ``WINDOW`` lines, or fewer with ``min_words``
words or more.  Every window selects the least of its lines, so two documents
that share a run select the same lines of each of its windows; these are the
fingerprints.  Least is the rarest by a fixed array of counters (log2 of the
count of the line's cell), then by hash.

Positions that select one fingerprint meet in one place, each with the hashes
of the lines beside it.  There every match is extended both ways, line by
line, as far as the windows reach that selected it: among positions equal in
fingerprint and extension the earliest by (doc_id, line) stays, and the lines
of all later ones are deleted.  Longer runs are covered window by window, as
each of their windows has a fingerprint of its own.

A line that fills its cell of the counters (``HOT`` times the mean or more) is
no place for all its positions to meet: its windows meet by the digest of the
whole window instead, where equal ones are reduced to the earliest per batch
first.  So a line, passage or copy that occurs everywhere stays small.

Lines are compared without white space at their ends.  Blank lines are no
part of the sequence and stay, but a document that loses all its other lines
becomes empty.  With ``min_words=None`` only runs of ``WINDOW`` lines count.
Null text counts as empty; rows that share doc_id and text count as one
document, and of several places in one document the first is the earliest; a
null doc_id ranks first; an empty table gives no rows; further columns stay,
but one with the name of a result is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from histlake.llm import repeats as R
from histlake.llm.common import GOLDEN, joined, mix, prepare, scatter, shuffle_blocks, slices, text_column, with_bytes

WINDOW = 3
MIN_WORDS = 8                # of a run with fewer lines
CELLS = 1 << 18              # counters of line hashes
CHUNK = 1 << 14              # counters that travel in one row
HOT, HOT_LEAST = 64, 4096    # a cell is hot at so many times the mean, and at least so many lines
RESULT = ("n_lines", "n_removed", "runs", "kept_sha256")
#: Lines before and after the fingerprint in each shape of window.
SHAPES = tuple((n - 1 - r, r) for n in range(1, WINDOW + 1) for r in range(n))


def worded_lines(text: bytes) -> list[int]:
    return [i for i, x in enumerate(text.split(b"\n")) if x and not x.isspace()]


class Lines:
    """The lines with a word of many texts end to end."""

    def __init__(self, texts: list[bytes]):
        per = [[x.strip() for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
        every = [x for lines in per for x in lines]
        #: two 64-bit hashes of each line
        self.h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, every)), np.uint64).reshape(-1, 2)
        count = np.fromiter(map(len, per), np.int64, len(per))
        self.doc = np.repeat(np.arange(len(per)), count)
        #: first line of each line's text, and the line after its last
        self.low, self.high = np.repeat(count.cumsum() - count, count), np.repeat(count.cumsum(), count)
        #: words before each line
        self.words = np.concatenate([[0], np.cumsum(np.fromiter((len(x.split()) for x in every), np.int64, len(every)))])

    def cells(self) -> np.ndarray:
        return (self.h[:, 0] & np.uint64(CELLS - 1)).astype(np.int64)


def windows(lines: Lines, min_words: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the shortest runs that count: the shortest from each
    line on, and the shortest up to each line unless it is one of the first
    kind.

    They cover any run that counts: up to a line of it reaches either the run
    that ends there, or too little, and then the one from its first line on
    passes that line."""
    n, words = len(lines.doc), lines.words
    at = np.arange(n + 1)
    end, start = at + WINDOW, at - WINDOW
    if min_words is not None:
        end = np.minimum(end, np.searchsorted(words, words + min_words, "left"))
        start = np.maximum(start, np.searchsorted(words, words - min_words, "right") - 1)
    onward = np.flatnonzero(end[:n] <= lines.high)
    back = 1 + np.flatnonzero(start[1:] >= lines.low)
    back = back[end[start[back]] != back]
    return np.concatenate([onward, start[back]]), np.concatenate([end[onward], back])


def line_counters(docs: DataFrame) -> np.ndarray:
    """How many lines fall into each cell; a fixed number of bytes whatever
    the input."""
    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for b in slices(batches):
            cell, times = np.unique(Lines(text_column(b)).cells(), return_counts=True)
            total[cell] += times
        parts = [(i, part) for i, part in enumerate(total.reshape(-1, CHUNK)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()),
                                          pa.array([p.tobytes() for _, p in parts], pa.binary())], names=["chunk", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["chunk", "counts"])

    ddl = "chunk int, counts binary"
    out = np.zeros(CELLS, np.int64)
    for r in with_bytes(docs).mapInArrow(count, ddl).repartition(CELLS // CHUNK, "chunk").mapInArrow(add, ddl).collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def ranks_and_hot(counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each cell: the class that orders its lines, and whether it is hot."""
    return np.log2(counters + 1).astype(np.uint64), counters >= max(HOT_LEAST, HOT * counters.mean())


def window_digest(h: np.ndarray, start: np.ndarray, end: np.ndarray, shape: np.ndarray) -> list[np.ndarray]:
    halves = []
    with np.errstate(over="ignore"):
        for side in (0, 1):
            acc = shape.astype(np.uint64) + np.uint64(1)
            for i in range(WINDOW):
                line = np.minimum(start + i, len(h) - 1)
                acc = np.where(start + i < end, mix(acc * GOLDEN + h[line, side]), acc)
            halves.append(acc)
    return halves


def fingerprints(lines: Lines, classes: np.ndarray, hot: np.ndarray, min_words: int | None) -> tuple[np.ndarray, ...]:
    """key0, key1, beside (hashes of the lines around, as far as needed),
    line, shapes (bits of the windows that selected the line), text."""
    h = lines.h
    start, end = windows(lines, min_words)
    cell = lines.cells()
    rank = (classes[cell] << np.uint64(58)) | (h[:, 0] >> np.uint64(6))
    least = start.copy()
    for i in range(1, WINDOW):                   # of equal lines the last
        at = np.minimum(start + i, len(h) - 1)
        least = np.where((start + i < end) & (rank[at] <= rank[least]), at, least)
    shape = np.zeros(len(start), np.int64)
    for k, (before, after) in enumerate(SHAPES):
        shape[(least - start == before) & (end - 1 - least == after)] = k
    many = hot[cell[least]]
    bits = np.zeros(len(h), np.uint8)
    np.bitwise_or.at(bits, least[~many], (1 << shape[~many]).astype(np.uint8))
    at = np.flatnonzero(bits)
    beside = np.zeros((len(at), 2 * (WINDOW - 1)), np.uint64)
    reach = [np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)]
    for k, sides in enumerate(SHAPES):
        has = (bits[at] >> k & 1).astype(bool)
        for side in (0, 1):
            reach[side] = np.where(has, np.maximum(reach[side], sides[side]), reach[side])
    for i in range(1, WINDOW):
        for side, sign in ((0, -1), (1, 1)):
            near = np.clip(at + sign * i, 0, len(h) - 1)
            beside[:, side * (WINDOW - 1) + i - 1] = np.where(i <= reach[side], h[near, 0], 0)
    k0, k1 = window_digest(h, start[many], end[many], shape[many])
    line = np.concatenate([at, least[many]])
    return (np.concatenate([h[at, 0], k0]), np.concatenate([h[at, 1], k1]),
            np.concatenate([beside, np.zeros((len(k0), beside.shape[1]), np.uint64)]),
            line - lines.low[line], np.concatenate([bits[at], (1 << shape[many]).astype(np.uint8)]), lines.doc[line])


def later_runs(k0, k1, beside, doc, tag, line, bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per shape of window: the entries with an equal one at an earlier place
    (by fingerprint and extension), and the shape."""
    side = WINDOW - 1
    for k, (before, after) in enumerate(SHAPES):
        own = np.flatnonzero(bits >> np.uint8(k) & 1)
        if len(own) < 2:
            continue
        near = [beside[own, i] for i in range(before)] + [beside[own, side + i] for i in range(after)]
        keys = [k0[own], k1[own], *near]
        order = np.lexsort((line[own], tag[own], doc[own], *reversed(keys)))
        new = np.zeros(len(order), bool)
        new[0] = True
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        own = own[order]
        first = own[np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))]
        later = (doc[own] != doc[first]) | (tag[own] != tag[first]) | (line[own] != line[first])
        yield own[later], k


PART = pa.schema([(c, pa.int32() if c == "block" else pa.binary()) for c in ("block", "k0", "k1", "beside", "doc", "tag", "pos", "bits")])
PART_DDL = "block int, k0 binary, k1 binary, beside binary, doc binary, tag binary, pos binary, bits binary"


def _entries(docs: DataFrame, shared, min_words: int | None, blocks: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        classes, hot = shared.value
        texts = text_column(batch)
        lines = Lines(texts)
        if not len(lines.doc):
            return
        k0, k1, beside, line, bits, owner = fingerprints(lines, classes, hot, min_words)
        if not len(line):
            return
        doc = np.array([R.NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)[owner]
        tag = np.fromiter(map(R.text_tag, texts), np.uint64, len(texts))[owner]
        # of entries that are equal in all they carry only the earliest travels on
        keys = [k0, k1, *beside.T, bits]
        order = np.lexsort((line, tag, doc, *reversed(keys)))
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([key[order][1:] != key[order][:-1] for key in keys])
        first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        again = (doc[order] != doc[first]) | (tag[order] != tag[first]) | (line[order] != line[first])
        kept, gone = order[new], order[~new & again]
        pos = line.astype(np.uint32)
        for b, cols in scatter((k0[kept] % np.uint64(blocks)).astype(np.int64), *(c[kept] for c in (k0, k1, beside, doc, tag, pos, bits))):
            yield (b, *cols)
        for k in range(len(SHAPES)):
            own = gone[(bits[gone] >> np.uint8(k) & 1).astype(bool)]
            for b, cols in scatter(R._block_of(doc[own], blocks), doc[own], tag[own], pos[own] * np.uint32(len(SHAPES)) + np.uint32(k)):
                yield (-1 - b, b"", b"", b"", *cols, b"")

    def run(batches):
        for b in slices(batches):
            got = list(rows(b))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), PART, strict=True)],
                                                 schema=PART)

    return with_bytes(docs.withColumn("doc_id", docs["doc_id"].cast("long")), "doc_id").mapInArrow(run, PART_DDL)


def later_windows(docs: DataFrame, min_words: int | None) -> DataFrame:
    """doc_key, text_tag, pos: line * shapes + shape of every window that
    occurs earlier, by its fingerprint's line."""
    spark = prepare(docs.sparkSession)
    blocks = shuffle_blocks(spark)
    shared = spark.sparkContext.broadcast(ranks_and_hot(line_counters(docs)))

    def find(t: pa.Table) -> pa.Table:
        doc, tag, pos = joined(t["doc"], np.int64), joined(t["tag"], np.uint64), joined(t["pos"], np.uint32)
        if t["block"][0].as_py() >= 0:
            beside = joined(t["beside"], np.uint64).reshape(len(doc), -1)
            found = list(later_runs(joined(t["k0"], np.uint64), joined(t["k1"], np.uint64), beside, doc, tag, pos,
                                    joined(t["bits"], np.uint8)))
            own = np.concatenate([i for i, _ in found]) if found else np.zeros(0, np.int64)
            shape = np.concatenate([np.full(len(i), k, np.uint32) for i, k in found]) if found else np.zeros(0, np.uint32)
            doc, tag, pos = doc[own], tag[own], pos[own] * np.uint32(len(SHAPES)) + shape
        return R.scattered(blocks, doc, tag, pos)

    return R.by_document(_entries(docs, shared, min_words, blocks).groupBy("block").applyInArrow(find, R.LATER_DDL))


def spans_of(codes: np.ndarray) -> list[tuple[int, int]]:
    line, shape = codes.astype(np.int64) // len(SHAPES), codes.astype(np.int64) % len(SHAPES)
    before, after = np.array(SHAPES).T
    return list(zip((line - before[shape]).tolist(), (line + after[shape] + 1).tolist(), strict=True))


def dedup_lines(docs: DataFrame, min_words: int | None = MIN_WORDS) -> DataFrame:
    """All columns of ``docs``, the text without later runs, and n_lines,
    n_removed (lines), runs (ranges of removed lines, numbered among the
    lines with a word), kept_sha256."""
    if min_words is not None and min_words < 1:
        raise ValueError("min_words must be at least 1")
    found = R.attached(docs, later_windows(docs, min_words))
    names = [c for c in docs.columns if c not in RESULT]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    extra = "n_lines long, n_removed long, runs array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for b in batches:
            texts, stats = [], []
            for t, p in zip(b.column("text").to_pylist(), b.column("__llm_pos").to_pylist(), strict=True):
                raw = (t or "").encode()
                lines = raw.split(b"\n")
                worded = worded_lines(raw)
                runs = R.merged(spans_of(np.frombuffer(p or b"", np.uint32)))
                gone = {worded[i] for x, y in runs for i in range(x, y)}
                if len(gone) == len(worded) and gone:
                    kept = b""
                else:
                    kept = b"\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else raw
                texts.append(t if t is None else kept.decode())
                stats.append((len(worded), len(gone), [{"start": x, "end": y} for x, y in runs],
                              hashlib.sha256(kept).hexdigest()))
            cols = [pa.array(texts, b.column("text").type) if n == "text" else b.column(n) for n in names]
            n = list(zip(*stats, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n[0], pa.int64()), pa.array(n[1], pa.int64()), pa.array(n[2], span), pa.array(n[3], pa.string())],
                names=[*names, *RESULT])

    return found.select(*names, "__llm_pos").mapInArrow(run, f"{types}, {extra}")
