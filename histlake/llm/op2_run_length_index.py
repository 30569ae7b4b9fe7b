"""Suffix-array dedup with a run-length index.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
in a document with a smaller doc_id.  Texts are judged on the input.

1. Anchors.  Every string of 50 bytes owns the smallest hash among its 31
   grams of 20 bytes, so equal strings own equal anchors.  An anchor's context
   is the bytes that its strings cover.  Documents are stored once in batches of bounded
   size; a batch sends a key of each anchor and context to a block of the hash
   space, in order.  Blocks find the anchors of two documents or more, and those
   whose contexts vary, and answer each batch with one bit per key.
2. Contexts.  A second pass joins the batches with their answers and sends the
   contexts of marked anchors to blocks, as digests where an anchor has one context only.  Equal
   contexts of neighbouring batches travel once.  Documents after the first holder of a
   context have all of it removed.
3. Run-length index.  In its block, contexts that differ but share an
   anchor and 15 bytes beside it become one text.  Its Burrows-Wheeler transform is kept as runs,
   broken where 50-byte intervals end, each run with a sample: the smallest
   doc_id of its rows.  Every context is streamed through the index from
   the right, extending its match by one byte per step (rank over the runs)
   and cutting it back to 49 bytes when it is 50 long: the matching
   statistics capped at 50.  A string whose interval holds a smaller doc_id
   than the context's own is marked.

Memory of a task is bounded by its block; a gram with more contexts than one
index takes is split by the strings themselves.  Null text counts as empty.  Rows that share a doc_id
never remove each other's bytes; rows that also share the text get the same
result; a null doc_id ranks first, and rows without one share it; an empty
table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm import repeats as R
from histlake.llm.common import GOLDEN, joined, mix, prepare, saved, scatter, shuffle_blocks, text_column

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1     # grams in one string
GRAM_BITS = 28               # of an anchor's key, besides those of its block; the rest of 64 is the context's
ANCHOR_TEXT = 1 << 14        # bytes hashed at a time: arrays that workers need not map anew (WORKER_SETTINGS)
BATCH_ROWS = 2000            # documents stored in one row
BATCH_TEXT = 4 << 20         # bytes of text in one row, if more than one document
LOT_INDEX_BYTES = 1 << 19    # text of an index of several grams; building one takes about 180 times as many bytes
INDEX_BYTES = 2 << 20        # text of one index at most
LOT_BYTES = 4 << 20          # context bytes of a block that are searched at a time
LOT = 200_000                # contexts that a task holds before it sends them
NO_GRAM = np.uint64(0xFFFFFFFFFFFFFFFF)
POLY = np.uint64(0xD6E8FEB86659FD93)
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position (fewer at the end: no gram)."""
    n = len(data)
    with np.errstate(over="ignore"):
        wide = {1: BYTE_HASH[data]}
        factor, size = GOLDEN, 1
        while size * 2 <= GRAM:
            h = wide[size]
            wide[size * 2] = h[:len(h) - size] * factor + h[size:]
            factor = factor * factor
            size *= 2
        out, done = None, 0
        for size in sorted(wide, reverse=True):
            while done + size <= GRAM:
                part = wide[size][done:done + n - GRAM + 1]
                out = part if out is None else out * POLY + part
                done += size
        return mix(out)


INVERSE = pow(int(GOLDEN), -1, 1 << 64)
POWERS = {int(GOLDEN): np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    if len(POWERS[base]) < n:
        POWERS[base] = np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)].cumprod(dtype=np.uint64)
    return POWERS[base][:n]


def sliding(a: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over ``size`` neighbours from each position."""
    width = 1
    while width * 2 <= size:
        a = pick(a[:len(a) - width], a[width:])
        width *= 2
    rest = size - width
    return pick(a[:len(a) - rest], a[rest:]) if rest else a


def anchors(texts: list[bytes], most: int = ANCHOR_TEXT) -> tuple[np.ndarray, ...]:
    """doc, place, hash, first and last string start and context digest of every anchor, places
    counted in the texts' own bytes; about ``most`` bytes are handled at a time."""
    lots = np.cumsum([len(t) for t in texts]) // most
    found, at = [], 0
    for n in np.unique(lots, return_counts=True)[1].tolist():
        doc, *rest = _anchors(texts[at:at + n])
        found.append((doc + at, *rest))
        at += n
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else _anchors([])


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, np.zeros(0, np.uint64), none, none, np.zeros(0, np.uint64)
    ends = sizes.cumsum()
    h = gram_hashes(data)
    valid = np.ones(len(h), bool)
    for e in ends[:-1]:
        valid[max(0, e - GRAM + 1):e] = False
    h = np.where(valid, np.minimum(h, NO_GRAM - np.uint64(1)), NO_GRAM)
    low = sliding(h, SPAN, np.minimum)
    for e in ends[:-1]:                                   # strings that leave their text
        low[max(0, e - LENGTH + 1):e] = 0
    # an anchor is the minimum of some string that holds it
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), low, np.zeros(SPAN - 1, np.uint64)])
    at = np.flatnonzero(sliding(padded, SPAN, np.maximum) == h)
    doc = np.searchsorted(ends, at, side="right")
    start, end, own = (ends - sizes)[doc], ends[doc], h[at]
    first, last = np.maximum(at - SPAN + 1, start), np.minimum(at, end - LENGTH)
    # an equal anchor to the left or a smaller one on either side takes over
    step, live = 1, np.arange(len(at))
    while len(live := live[live >= step]):
        live = live[at[live] - at[live - step] < SPAN]
        stops = own[live - step] <= own[live]
        hit = live[stops]
        first[hit] = np.maximum(first[hit], at[hit - step] + 1)
        live = live[~stops]
        step += 1
    step, live = 1, np.arange(len(at))
    while len(live := live[live < len(at) - step]):
        live = live[at[live + step] - at[live] < SPAN]
        stops = own[live + step] < own[live]
        hit = live[stops]
        last[hit] = np.minimum(last[hit], at[hit + step] - SPAN)
        live = live[~stops]
        step += 1
    keep = first <= last
    doc, at, own, first, last, start = (x[keep] for x in (doc, at, own, first, last, start))
    # digests of contexts as differences of running sums
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), (BYTE_HASH[data] * powers(int(GOLDEN), len(data))).cumsum(dtype=np.uint64)]
        digest = mix((sums[last + LENGTH] - sums[first]) * powers(INVERSE, len(data))[first])
    return doc, at - start, own, first - start, last - start, digest


def batches_of(docs: DataFrame) -> DataFrame:
    """Documents in batches of bounded size, one row each: batch, doc_id (as
    given), id (as a number), size and text, end to end."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(R.NULL_ID)).alias("id"),
                         F.col("text").cast("binary").alias("text"))

    def run(arrow):
        first = TaskContext.get().partitionId() << 32
        for b in arrow:
            texts = text_column(b)
            size = np.fromiter(map(len, texts), np.int64, len(texts))
            lot = np.maximum(size.cumsum() // BATCH_TEXT, np.arange(len(size)) // BATCH_ROWS)
            for own in np.split(np.arange(len(size)), np.flatnonzero(np.diff(lot)) + 1):
                if not len(own):
                    continue
                lo, hi = int(own[0]), int(own[-1]) + 1
                ids = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), pa.concat_arrays([b.column("doc_id").slice(lo, hi - lo)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first], pa.int64()), ids, *(pa.array([x], pa.binary()) for x in (
                        b.column("id").slice(lo, hi - lo).to_numpy(zero_copy_only=False).tobytes(), size[lo:hi].tobytes(),
                        zstandard.compress(b"".join(texts[lo:hi]), 3)))], names=["batch", "doc_id", "id", "size", "text"])
                first += 1

    return narrow.mapInArrow(run, f"batch long, doc_id array<{kind}>, id binary, size binary, text binary")


def batch_texts(row: dict) -> list[bytes]:
    raw, end = zstandard.decompress(row["text"]), np.frombuffer(row["size"], np.int64).cumsum().tolist()
    return [raw[a:b] for a, b in zip([0, *end], end, strict=False)]


def rows_of(arrow) -> Iterator[dict]:
    for b in arrow:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


class Keys:
    """The distinct keys of a batch's anchors, by block and in order, so that
    answers about them need no names."""

    def __init__(self, texts: list[bytes], bits: int):
        u = np.uint64
        self.found = doc, _, h, _, _, digest = anchors(texts)
        h = mix(h)                                        # anchors are small numbers: deal them evenly
        key = (h << u(bits)) >> u(64 - GRAM_BITS) << u(64 - GRAM_BITS) | digest >> u(GRAM_BITS)
        block = (h >> u(64 - bits)).astype(np.uint16) if bits else np.zeros(len(h), np.uint16)
        order = np.argsort(key)
        order = order[np.argsort(block[order], kind="stable")]
        key, self.order, block = key[order], order, block[order]
        gram = key >> u(64 - GRAM_BITS)
        start = np.r_[True, (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])][:len(key)]
        new = start | np.r_[True, key[1:] != key[:-1]][:len(key)]
        self.which = new.cumsum() - 1
        self.key, self.block = key[new], block[new]
        if len(key):
            heads, doc = np.flatnonzero(start), doc[order]
            several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
            self.many = several[start.cumsum()[new] - 1]            # its anchor is in two documents of the batch

    def flags(self, answers: list[dict]) -> np.ndarray:
        """Per anchor: held by two documents, and that with different contexts."""
        out = np.zeros((2, len(self.key)), bool)
        for a in answers:
            lo, hi = np.searchsorted(self.block, [a["block"], a["block"] + 1])
            out[0, lo:hi] = np.unpackbits(np.frombuffer(a["again"], np.uint8), count=hi - lo)
            out[1, lo:hi] = np.unpackbits(np.frombuffer(a["varied"], np.uint8), count=hi - lo)
        by_anchor = np.empty((2, len(self.order)), bool)
        by_anchor[:, self.order] = out[:, self.which]
        return by_anchor


ANSWERS = pa.schema([("batch", pa.int64()), ("block", pa.int32()), ("again", pa.binary()), ("varied", pa.binary())])


def answer(t: pa.Table) -> pa.Table:
    """Which of the keys of one block belong to anchors of two documents or more,
    and which of them to different contexts: bits per batch, in its order."""
    keys, many = t["key"].to_pylist(), t["many"].to_pylist()
    count = np.array([len(k) // 8 for k in keys])
    flags = [np.unpackbits(np.frombuffer(m, np.uint8), count=n) for n, m in zip(count.tolist(), many, strict=True)]
    batch = np.repeat(np.arange(len(keys), dtype=np.int32), count)
    key, many = np.frombuffer(b"".join(keys), np.uint64), np.concatenate(flags) > 0
    order = np.argsort(key)
    key, many, batch = key[order], many[order], batch[order]
    gram = key >> np.uint64(64 - GRAM_BITS)
    start = np.r_[True, gram[1:] != gram[:-1]]
    heads, group = np.flatnonzero(start), start.cumsum() - 1
    again = np.maximum.reduceat(many, heads) | (np.minimum.reduceat(batch, heads) != np.maximum.reduceat(batch, heads))
    varied = again & (np.minimum.reduceat(key, heads) != np.maximum.reduceat(key, heads))
    bits, cut, out = np.empty((2, len(key)), bool), count.cumsum()[:-1], []
    bits[:, order] = np.stack([again[group], varied[group]])
    for i, (a, v) in enumerate(zip(np.split(bits[0], cut), np.split(bits[1], cut), strict=True)):
        if a.any():
            out.append((t["batch"][i].as_py(), t["block"][i].as_py(), np.packbits(a).tobytes(), np.packbits(v).tobytes()))
    return pa.table([pa.array([x[i] for x in out], f.type) for i, f in enumerate(ANSWERS)], schema=ANSWERS)


def answers(stored: DataFrame, bits: int) -> DataFrame:
    """batch, found: the answers of all blocks to a batch's keys."""
    def run(arrow):
        for row in rows_of(arrow):
            k = Keys(batch_texts(row), bits)
            got = [(b, c, np.packbits(np.frombuffer(m, bool)).tobytes()) for b, (c, m) in (scatter(k.block, k.key, k.many) if len(k.key) else ())]
            yield pa.RecordBatch.from_arrays([pa.array([row["batch"]] * len(got), pa.int64()), pa.array([g[0] for g in got], pa.int32()), *(
                pa.array([g[i] for g in got], pa.binary()) for i in (1, 2))], names=["batch", "block", "key", "many"])

    found = stored.select("batch", "size", "text").mapInArrow(run, "batch long, block int, key binary, many binary").groupBy("block").applyInArrow(
        answer, "batch long, block int, again binary, varied binary")
    return found.groupBy("batch").agg(F.collect_list(F.struct("block", "again", "varied")).alias("found"))


PART = pa.schema([("block", pa.int32()), ("text", pa.binary()), ("size", pa.binary()), ("off", pa.binary()), ("id", pa.binary()),
                  ("batch", pa.binary()), ("doc", pa.binary()), ("pos", pa.binary())])
SPANS = pa.schema([("batch", pa.int64()), ("doc", pa.binary()), ("lo", pa.binary()), ("hi", pa.binary())])


def joined_spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans in order, those of one document that overlap or touch as one."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    shift = np.r_[0, (doc[1:] != doc[:-1]).cumsum()][:len(doc)] << 33
    top = np.maximum.accumulate(hi + shift)
    at = np.flatnonzero(np.r_[True, (lo + shift)[1:] > top[:-1]][:len(doc)])
    end = np.r_[at[1:], len(doc)][:len(at)] - 1
    return doc[at], lo[at], (top - shift)[end]


def spans_table(batch: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Table:
    """Spans as one row per batch of documents."""
    names, own = np.unique(batch, return_inverse=True)
    both, lo, hi = joined_spans(own << 32 | doc, lo, hi)
    got = [(int(names[b]), *cols) for b, cols in scatter(both >> 32, *(x.astype(np.uint32) for x in (both & 0xFFFFFFFF, lo, hi)))]
    return pa.table([pa.array([g[i] for g in got], f.type) for i, f in enumerate(SPANS)], schema=SPANS)


def packed(column: np.ndarray) -> bytes:
    return zstandard.compress(column.tobytes(), 1)


def unpacked(cells: list[bytes], dtype) -> np.ndarray:
    return np.frombuffer(b"".join(map(zstandard.decompress, cells)), dtype)


def document_numbers(cells: list[bytes]) -> np.ndarray:
    """doc_ids travel as differences within a cell."""
    return np.concatenate([np.frombuffer(zstandard.decompress(c), np.int64).cumsum() for c in cells])


def contexts(stored: DataFrame, bits: int, blocks: int) -> DataFrame:
    """The contexts of repeated anchors, by the anchor's block: their bytes
    where contexts vary, else a 64-bit digest of the one context."""
    def lot(row: dict) -> tuple | None:
        if not row["found"]:
            return None
        texts, ids = batch_texts(row), np.frombuffer(row["id"], np.int64)
        k = Keys(texts, bits)
        again, varied = k.flags(row["found"])
        some = np.flatnonzero(again)
        doc, at, h, first, last = (x[some] for x in k.found[:5])
        last = last + LENGTH
        cut = [texts[d][a:b] for d, a, b in zip(doc.tolist(), first.tolist(), last.tolist(), strict=True)]
        return h, ids[doc], np.full(len(doc), row["batch"]), doc, first, last, at - first, varied[some], np.array(cut, object)

    def cells(block, text, doc, batch, number, pos, *sizes) -> tuple:
        return (block, text, *map(packed, sizes), packed(np.diff(doc, prepend=0)), packed(np.diff(batch, prepend=0)),
                packed(number.astype(np.uint32)), packed(pos.astype(np.uint32)))

    def rows(lots: list[tuple]) -> Iterator[tuple]:
        h, doc, batch, number, first, last, off, varied, cut = (np.concatenate(c) for c in zip(*lots, strict=True))
        by_id = np.argsort(doc, kind="stable")
        h, doc, batch, number, first, last, off, varied, cut = (x[by_id] for x in (h, doc, batch, number, first, last, off, varied, cut))
        # a context's first holder in the lot stands for it; later documents lose it whole
        holder: dict[bytes, int] = {}
        later = doc > np.fromiter((holder.setdefault(c, d) for c, d in zip(cut, doc.tolist(), strict=True)), np.int64, len(cut))
        parts = np.where(later, -1 - (mix(batch.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64),
                         (h % np.uint64(blocks)).astype(np.int64) * 2 + varied)
        order = np.argsort(parts, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1):
            block = int(parts[own[0]])
            if block < 0:
                own = own[np.argsort(batch[own], kind="stable")]
                for b in np.split(own, np.flatnonzero(np.diff(batch[own])) + 1):
                    which, lo, hi = joined_spans(number[b], first[b], last[b])
                    none = which[:0]
                    yield cells(block, b"", none, np.full(len(which), batch[b[0]]), which, lo, hi.astype(np.uint32), none.astype(np.uint8))
                continue
            text = zstandard.compress(b"".join(cut[own]), 3) if block % 2 else b"".join(xxhash.xxh3_64_digest(c) for c in cut[own])
            yield cells(block, text, doc[own], batch[own], number[own], first[own], (last - first)[own].astype(np.uint8), off[own].astype(np.uint8))

    def run(arrow):
        def emitted(lots):
            got = list(rows(lots))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), PART, strict=True)], schema=PART)

        lots, size = [], 0
        for row in rows_of(arrow):
            if (x := lot(row)) is not None:
                lots.append(x)
                size += len(x[0])
            if size >= LOT:
                yield emitted(lots)
                lots, size = [], 0
        if lots:
            yield emitted(lots)

    told = stored.select("batch", "id", "size", "text").join(answers(stored, bits).hint("SHUFFLE_HASH"), "batch", "left")
    return told.mapInArrow(run, "block int, text binary, size binary, off binary, id binary, batch binary, doc binary, pos binary")


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of a set of byte strings, with
    the smallest owner of each run's rows as its sample."""

    def __init__(self, strings: list[bytes], owners: np.ndarray):
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        codes = np.zeros(int(sizes.sum()) + len(strings), np.uint8)          # 0 ends a string
        self.starts = np.r_[0, (sizes + 1).cumsum()[:-1]]
        inside = np.ones(len(codes), bool)
        inside[self.starts + sizes] = False
        codes[inside] = np.frombuffer(b"".join(strings), np.uint8) + 1         # UTF-8 has no byte 255
        self.codes, self.sizes, self.n = codes, sizes, len(codes)
        order, half = self._sorted()
        # rows that share 49 and 50 bytes with the row before
        self.cut49, self.cut50 = self._breaks(order, half, LENGTH - 1), self._breaks(order, half, LENGTH)
        last = codes[order - 1]
        owner = np.repeat(owners, sizes + 1)[order]
        heads = np.flatnonzero(np.r_[True, last[1:] != last[:-1]] | self.cut50)
        self.sample = np.minimum.reduceat(owner, heads)
        run_char, run_len = last[heads].astype(np.int64), np.diff(np.r_[heads, self.n])
        by_char = np.lexsort((heads, run_char))
        self.run_key = run_char[by_char] * (self.n + 1) + heads[by_char]
        self.run_char, self.run_at, self.run_len = run_char[by_char], heads[by_char], run_len[by_char]
        before = self.run_len.cumsum() - self.run_len
        new = np.r_[True, self.run_char[1:] != self.run_char[:-1]]
        self.before = before - before[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        counts = np.bincount(codes, minlength=257)
        self.first_row = counts.cumsum() - counts
        # 50-byte intervals: rows and smallest sample
        rows50 = np.flatnonzero(self.cut50)
        self.interval = self.cut50.cumsum() - 1
        self.smallest = np.minimum.reduceat(self.sample, np.searchsorted(heads, rows50))
        self.rows49 = np.flatnonzero(self.cut49)
        self.interval49 = self.cut49.cumsum() - 1

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order (prefix doubling), and their ranks by 32 bytes."""
        n = self.n
        tail = np.r_[self.codes, np.zeros(8, np.uint8)].astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | tail[i:i + n]
        order = np.argsort(key)
        width, half = 8, None
        rank = np.empty(n, np.int64)
        s = key[order]
        rank[order] = np.r_[False, s[1:] != s[:-1]].cumsum()
        while True:
            if width == 32:
                half = rank.copy()
            if width >= LENGTH:                       # matches end there: suffixes need no order beyond
                return order, half
            nxt = np.zeros(n, np.int64)
            if width < n:
                nxt[:n - width] = rank[width:] + 1
            key = rank * (n + 1) + nxt
            order = np.argsort(key)
            s = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.r_[False, s[1:] != s[:-1]].cumsum()
            width *= 2

    def _breaks(self, order: np.ndarray, half: np.ndarray, length: int) -> np.ndarray:
        """True where a row and the one before differ in their first ``length`` bytes."""
        tail = np.r_[half, np.zeros(length, np.int64) - 1 - np.arange(length)]
        a, b = order[1:], order[:-1]
        same = (half[a] == half[b]) & (tail[a + length - 32] == tail[b + length - 32])
        return np.r_[True, ~same]

    def rank(self, char: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``char`` occurs in the transform before ``row``."""
        at = np.searchsorted(self.run_key, char * (self.n + 1) + row, side="left") - 1
        there = np.maximum(at, 0)
        count = self.before[there] + np.minimum(row - self.run_at[there], self.run_len[there])
        return np.where((at >= 0) & (self.run_char[there] == char), count, 0)

    def smallest_owner(self, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Streams the strings through the index from the right.  Yields
        (string, start, smallest owner of the 50 bytes from there)."""
        end = self.starts[which] + self.sizes[which]
        live = np.arange(len(which))
        low = np.zeros(len(which), np.int64)                # first row of the match; every string is in the index
        for step in range(1, int(self.sizes[which].max(initial=0)) + 1):
            live = live[self.sizes[which[live]] >= step]
            at = end[live] - step
            char = self.codes[at].astype(np.int64)
            row = self.first_row[char] + self.rank(char, low[live])
            if step >= LENGTH:
                yield live, at - self.starts[which[live]], self.smallest[self.interval[row]]
                row = self.rows49[self.interval49[row]]
            low[live] = row


def repeats(strings: list[bytes], owners: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """string and start of every 50 bytes of the strings ``which`` that also
    occur in a string of a smaller owner."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if len(which):
        for who, start, smallest in RunLengthIndex(strings, owners).smallest_owner(which):
            hit = smallest < owners[which[who]]
            found.append((which[who[hit]], start[hit]))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def repeats_in(strings: list[bytes], owners: np.ndarray) -> list[tuple[int, int]]:
    """(string, start) of every 50 bytes that also occur in a string of a
    smaller owner."""
    return list(zip(*(x.tolist() for x in repeats(strings, owners, np.arange(len(strings)))), strict=True))


def _bounded(groups: list[list[int]], strings: list[bytes]) -> Iterator[list[list[int]]]:
    """Groups in lots that share an index; a larger group is a lot of its own."""
    lot, size = [], 0
    for g in groups:
        own = sum(len(strings[i]) for i in g)
        if lot and size + own > LOT_INDEX_BYTES:
            yield lot
            lot, size = [], 0
        lot.append(g)
        size += own
    if lot:
        yield lot


def block_spans(strings: list[bytes], offs: list[int], docs: np.ndarray, pos: np.ndarray) -> list[tuple[int, int, int]]:
    """(entry, lo, hi) of the bytes to remove, from the entries of one block."""
    holders: dict[bytes, list[int]] = {}
    for i, s in enumerate(strings):
        holders.setdefault(s, []).append(i)
    out, by_gram, gram_at = [], {}, []
    texts, owners = list(holders), []
    for k, (s, own) in enumerate(holders.items()):
        least = int(docs[own].min())
        owners.append(least)
        out += [(i, int(pos[i]), int(pos[i]) + len(s)) for i in own if docs[i] > least]
        gram_at.append(offs[own[0]])
    owners = np.array(owners, np.int64)

    # 50 equal bytes reach 15 bytes beyond the gram on one side at least
    reach = (LENGTH - GRAM + 1) // 2
    sides = [[s[a - reach:a + GRAM] if a >= reach else None for s, a in zip(texts, gram_at, strict=True)],
             [s[a:a + GRAM + reach] if len(s) - a >= GRAM + reach else None for s, a in zip(texts, gram_at, strict=True)]]
    counts = [Counter(side) for side in sides]
    for k, (s, a) in enumerate(zip(texts, gram_at, strict=True)):
        if any(side[k] is not None and count[side[k]] > 1 for side, count in zip(sides, counts, strict=True)):
            by_gram.setdefault(s[a:a + GRAM], []).append(k)

    # entries that are not removed whole, by text; a gram's first owner loses nothing
    sizes = np.fromiter(map(len, holders.values()), np.int64, len(texts))
    entry = np.fromiter((i for own in holders.values() for i in own), np.int64, len(strings))
    kept = docs[entry] == np.repeat(owners, sizes)
    holds = np.add.reduceat(kept, sizes.cumsum() - sizes, dtype=np.int64) if len(texts) else sizes
    entry, heads = entry[kept], holds.cumsum() - holds
    may, least = np.zeros(len(texts), bool), owners.tolist()
    for g in by_gram.values():
        first = min(least[k] for k in g)
        for k in g:
            may[k] = least[k] > first

    def found(which: list[int], parts: list[bytes], shift: list[int]):
        which = np.array(which)
        j, start = repeats(parts, owners[which], np.flatnonzero(may[which]))
        k, at = which[j], start + np.array(shift, np.int64)[j]
        several = holds[k]
        i = entry[np.repeat(heads[k] - (several.cumsum() - several), several) + np.arange(int(several.sum()))]
        lo = pos[i] + np.repeat(at, several)
        out.extend(zip(i.tolist(), lo.tolist(), (lo + LENGTH).tolist(), strict=True))

    several = [g for g in by_gram.values() if len(g) > 1]
    for lot in _bounded(several, texts):
        which = [k for g in lot for k in g]
        if sum(len(texts[k]) for k in which) <= INDEX_BYTES:
            found(which, [texts[k] for k in which], [0] * len(which))
            continue
        # one gram with more text than an index takes: equal strings share a part
        count = np.array([len(texts[k]) - LENGTH + 1 for k in which])
        own = np.repeat(which, count)
        at = np.arange(len(own)) - np.repeat(count.cumsum() - count, count)
        parts = 1 + len(own) * LENGTH // INDEX_BYTES
        part = np.fromiter((zlib.crc32(texts[k][a:a + LENGTH]) % parts for k, a in zip(own.tolist(), at.tolist(), strict=True)),
                           np.int64, len(own))
        order = np.argsort(part, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            ks, starts = own[some].tolist(), at[some].tolist()
            found(ks, [texts[k][a:a + LENGTH] for k, a in zip(ks, starts, strict=True)], starts)
    return out


def gram_lots(raw: bytes, gram_at: np.ndarray) -> Iterator[np.ndarray]:
    """Entries of a block in lots of about ``LOT_BYTES`` of text; entries that
    share a gram share a lot."""
    lots = 1 + len(raw) // LOT_BYTES
    if lots == 1:
        yield np.arange(len(gram_at))
        return
    head = np.frombuffer(raw, np.uint8)[gram_at[:, None] + np.arange(8)].view(np.uint64).ravel()
    lot = mix(head) % np.uint64(lots)
    order = np.argsort(lot, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(lot[order])) + 1)


def removed_spans(stored: DataFrame) -> DataFrame:
    """batch, spans: raw arrays of document, lo and hi of the bytes to remove."""
    blocks = shuffle_blocks(stored.sparkSession, 1)
    bits = min((4 * blocks - 1).bit_length(), 16)

    def search(t: pa.Table) -> pa.Table:
        block = t["block"][0].as_py()
        batch, number, pos = document_numbers(t["batch"].to_pylist()), *(unpacked(t[c].to_pylist(), np.uint32).astype(np.int64) for c in ("doc", "pos"))
        if block < 0:
            return spans_table(batch, number, pos, unpacked(t["size"].to_pylist(), np.uint32))
        doc, size = document_numbers(t["id"].to_pylist()), unpacked(t["size"].to_pylist(), np.uint8).astype(np.int64)
        if block % 2 == 0:                                # one context each: all but its first holder
            digest = joined(t["text"], np.uint64)
            order = np.lexsort((doc, digest))
            first = np.maximum.accumulate(np.where(np.r_[True, digest[order][1:] != digest[order][:-1]], np.arange(len(order)), 0))
            entry = order[doc[order] != doc[order][first]]
            lo, hi = pos[entry], (pos + size)[entry]
        else:
            raw = b"".join(map(zstandard.decompress, t["text"].to_pylist()))
            start, off, spans = size.cumsum() - size, unpacked(t["off"].to_pylist(), np.uint8), [np.zeros((0, 3), np.int64)]
            for own in gram_lots(raw, start + off):
                strings = [raw[a:a + n] for a, n in zip(start[own].tolist(), size[own].tolist(), strict=True)]
                part = np.array(block_spans(strings, off[own].tolist(), doc[own], pos[own]), np.int64).reshape(-1, 3)
                part[:, 0] = own[part[:, 0]]
                spans.append(part)
            entry, lo, hi = np.concatenate(spans).T
        return spans_table(batch[entry], number[entry], lo, hi)

    found = contexts(stored, bits, blocks).groupBy("block").applyInArrow(search, "batch long, doc binary, lo binary, hi binary")
    return found.groupBy("batch").agg(F.collect_list(F.struct("doc", "lo", "hi")).alias("spans"))


def dedup_strings(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document;
    with the kept bytes and the removed spans if ``with_text``."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = saved(batches_of(docs), "documents")
    found = stored.join(removed_spans(stored).hint("SHUFFLE_HASH"), "batch", "left")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(arrow):
        for b in arrow:
            for i in range(b.num_rows):
                row = b.select(["size", "text", "spans"]).slice(i, 1).to_pylist()[0]
                doc, lo, hi = joined_spans(*(np.frombuffer(b"".join(s[c] for s in row["spans"] or ()), np.uint32) for c in ("doc", "lo", "hi")))
                texts, out = batch_texts(row), []
                cut = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
                lo, hi = lo.tolist(), hi.tolist()
                for raw, x, y in zip(texts, cut, cut[1:], strict=False):
                    spans = list(zip(lo[x:y], hi[x:y], strict=True))
                    kept = R.without(raw, spans)
                    out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans))
                n = list(zip(*out, strict=True))
                cols = [b.column("doc_id").slice(i, 1).flatten(), *(pa.array(n[c], pa.int64()) for c in range(3)), pa.array(n[3], pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    cols += [pa.array(n[4], pa.binary()), pa.array([[{"start": x, "end": y} for x, y in s] for s in n[5]], span)]
                    names += ["kept", "removed"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    more = ", kept binary, removed array<struct<start:bigint,end:bigint>>"
    return found.mapInArrow(run, schema + more * with_text)
