"""Packing of documents into fixed windows by order-preserving dynamic programming.

Each partition packs its documents in the order it reads them (file order of
a stored table), streaming, without a shuffle.  The token stream may be cut
at a document end (no penalty), a sentence end (small) or, inside a sentence
of more than ``LONG_SENTENCE`` ids, every ``LONG_SENTENCE`` ids (large).  With cuts p_0 < p_1 < ... the
cheapest chain minimises the sum of padding and penalties:

    best(j) = cost(j) + min over p_j - p_i <= window of best(i) + window - (p_j - p_i)

The minimum of best(i) + p_i over the sliding range is the front of a
monotone queue, so each cut is handled in constant amortised time.  The last,
open window of a stretch opens the next stretch; at the end of the partition
it is cut into powers of two, which need no padding.

Null or empty text: the end-of-document id alone.  Repeated rows are packed
as often as they occur; a null or repeated doc_id is kept.  Of chains of equal
cost the one with the earlier cut is taken.  An empty table gives no rows;
other columns are ignored, whatever their names.  One text may span any number of windows.
Ids come from a public word BPE whose words do not depend on their
neighbours, hence ids are looked up by white-space separated chunk.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from histlake.llm.common import prepare

WINDOW = 2048
STRETCH = 1 << 18            # ids that one dynamic programme covers
END_ID = 1
SENTENCE_COST = 2
INNER_COST = 24
LONG_SENTENCE = 64
VOCABULARY = "word_bpe_49k.json"
#: Fixed value: Python white space that the tokenizer does not treat as such.
ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


class Ids(dict):
    """chunk -> its ids as little-endian 32-bit bytes; holds about ``limit``
    chunks and as many words."""

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.rare: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.marks = {c: self.ids(c).tobytes() for c in ".,!?;:"}
        ends = [i for w, i in self.tokenizer.get_vocab().items()
                if (s := w.replace("</w>", "")) and not s.strip(".!?")]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[ends] = True

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def simple(self, chunk: str) -> tuple[str, bytes] | None:
        """The one word of a chunk and the ids of the mark behind it, where
        lower-casing and splitting are plain (letters below U+0100)."""
        if chunk.isascii() or max(chunk) < "\u0100":
            word = chunk.lower()
            if word.isalpha():
                return word, b""
            if word[-1] in self.marks and word[:-1].isalpha():
                return word[:-1], self.marks[word[-1]]
        return None

    def learn_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are one piece each, many at a time."""
        found = {}
        for at in range(0, len(words), 5000):
            part = words[at:at + 5000]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            raw = np.array(encoded.ids, "<u4").tobytes()
            ends = (4 * np.searchsorted(np.array(encoded.word_ids), np.arange(1, len(part) + 1))).tolist()
            found.update(zip(part, (raw[i:j] for i, j in zip([0, *ends], ends, strict=False)), strict=True))
        return found

    def learn(self, chunks: set[str]) -> None:
        """Ids of unseen chunks."""
        split = {c: w for c in chunks if (w := self.simple(c))}
        known = self.words
        if new := {w for w, _ in split.values() if w not in known}:        # not a difference: that goes through all known
            fresh = self.learn_words(list(new))
            if len(known) < self.limit:
                known.update(fresh)
            else:
                known = {**{w: known[w] for w, _ in split.values() if w in known}, **fresh}
        found = {c: known[w] + mark for c, (w, mark) in split.items()}
        found |= {c: self.ids(c).tobytes() for c in chunks - split.keys()}
        if len(self) < self.limit:
            self.update(found)
        else:
            self.rare = found            # of the current batch only

    def __missing__(self, chunk: str) -> bytes:
        return self.rare[chunk]

    def of(self, texts: list[str]) -> list[bytes]:
        split = [None if any(s in t for s in ODD_SPACE) else t.split() for t in texts]
        found = [c and list(map(self.get, c)) for c in split]
        if new := {w for c, x in zip(split, found, strict=True) if x and None in x for w, i in zip(c, x, strict=True) if i is None}:
            self.learn(new)
            get = self.__getitem__
            found = [map(get, c) if x and None in x else x for c, x in zip(split, found, strict=True)]
        return [self.ids(t).tobytes() if x is None else b"".join(x) for t, x in zip(texts, found, strict=True)]


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def cut_points(ends: np.ndarray, sentences: np.ndarray) -> tuple[list[int], list[int]]:
    """Allowed cuts of a stream and their penalties. ``ends``: document ends,
    the last one closing the stream; ``sentences``: ends of sentences."""
    natural = np.union1d(ends, sentences)
    start = np.concatenate([[0], natural[:-1]])
    extra = (natural - start - 1) // LONG_SENTENCE
    owner = np.repeat(np.arange(len(natural)), extra)
    nth = np.arange(len(owner)) - np.repeat(extra.cumsum() - extra, extra) + 1
    inner = start[owner] + LONG_SENTENCE * nth
    points = np.concatenate([natural, inner])
    costs = np.concatenate([np.full(len(natural), SENTENCE_COST), np.full(len(inner), INNER_COST)])
    order = np.argsort(points, kind="stable")
    points, costs = points[order], costs[order]
    costs[np.searchsorted(points, ends)] = 0
    return [0, *points.tolist()], [0, *costs.tolist()]


def best_cuts(points: list[int], costs: list[int], window: int = WINDOW) -> list[int]:
    """The cheapest chain of cuts from the first point to the last."""
    back = [0] * len(points)
    reach = [0] * len(points)            # best(i) + p_i
    queue, head = [0], 0
    for j in range(1, len(points)):
        low = points[j] - window
        while points[queue[head]] < low:
            head += 1
        i = queue[head]
        back[j] = i
        reach[j] = value = reach[i] + window + costs[j]
        while len(queue) > head and reach[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    chain, j = [], len(points) - 1
    while j:
        chain.append(points[j])
        j = back[j]
    return [0, *reversed(chain)]


class Packer:
    """Packs one partition's documents in their order."""

    def __init__(self, window: int, is_end: np.ndarray, first: int):
        self.window, self.is_end, self.sequence = window, is_end, first
        self.open: list[tuple] = []      # (doc_id, start, ids, ids of the whole document)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray):
        self.open.append((doc_id, 0, ids, len(ids)))
        self.size += len(ids)
        return self.close(last=False) if self.size >= STRETCH else []

    def close(self, last: bool) -> list[tuple]:
        if not self.size:
            return []
        flat = np.concatenate([x[2] for x in self.open])
        ends = np.cumsum([len(x[2]) for x in self.open])
        points, costs = cut_points(ends, np.flatnonzero(self.is_end[flat]) + 1)
        cuts = best_cuts(points, costs, self.window)
        if last:
            rest, at = cuts[-1] - cuts[-2], cuts[-2]
            tail = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
            cuts = [*cuts[:-1], *(at + np.cumsum(tail)).tolist()]
        else:
            cuts = cuts[:-1]             # the open window goes on with what comes next
        rows, keep, at, done = [], [], 0, 0
        for doc_id, start, ids, total in self.open:
            lo, hi = at, at + len(ids)
            at = hi
            while lo < hi and done < len(cuts) - 1:
                to = min(hi, cuts[done + 1])
                part = ids[lo - hi + len(ids):to - hi + len(ids)]
                rows.append((doc_id, start + lo - hi + len(ids), part, total, self.sequence + done, lo - cuts[done]))
                lo = to
                done += to == cuts[done + 1]
            if lo < hi:
                keep.append((doc_id, start + lo - hi + len(ids), ids[lo - hi + len(ids):], total))
        self.sequence += len(cuts) - 1
        self.open, self.size = keep, sum(len(x[2]) for x in keep)
        return rows


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document; pieces of a sequence are gapless in
    ``offset``.  ``ids`` holds the piece's ids if ``with_ids``."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def batch_of(rows, id_type):
        cols = [pa.array([r[0] for r in rows], id_type), *(pa.array(v, pa.int64()) for v in (
            [r[1] for r in rows], [len(r[2]) for r in rows], [zlib.crc32(r[2].tobytes()) for r in rows],
            [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows]))]
        if with_ids:
            cols.append(pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches):
        ids = ids_of(tokenizer_path)
        packer = Packer(window, ids.is_end, TaskContext.get().partitionId() << 36)
        end = np.array([END_ID], "<u4").tobytes()
        id_type = None
        for whole in batches:
            id_type = whole.column("doc_id").type
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                rows = []
                texts = [t or "" for t in b.column("text").to_pylist()]
                for doc_id, x in zip(b.column("doc_id").to_pylist(), ids.of(texts), strict=True):
                    rows += packer.add(doc_id, np.frombuffer(x + end, "<u4"))
                if rows:
                    yield batch_of(rows, id_type)
        if rows := packer.close(last=True):
            yield batch_of(rows, id_type)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)
