"""Substring dedup by hashing lines and the sentences in them.

Units are the lines of a text and, in lines of several sentences, each
sentence.  A unit is normalised (ASCII letters lower-cased, white space
collapsed); units of fewer than ``MIN_WORDS`` words are never touched.
Digests are grouped globally, the earliest occurrence by (doc_id, offset)
stays, all others are removed.  Removed byte offsets refer to the original
text.

Null text counts as empty; rows that share doc_id and text count as one
document (each keeps its row); a null doc_id ranks first; further columns
stay, but one with the name of a result is replaced; an empty table gives no
rows.  White space behind a sentence does not make it a part of its own line.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm import repeats as R

MIN_WORDS = 8
RESULT = ("n_bytes", "n_units", "n_removed", "removed", "kept_sha256")
SENTENCE = re.compile(rb"[^.!?]*[.!?]+|[^.!?]+")


def units(text: bytes) -> list[tuple[int, int, bytes]]:
    """(start, end, normalised) of every unit that is long enough."""
    out, at = [], 0
    for line in text.split(b"\n"):
        spans = [(at, at + len(line))]
        # white space behind a sentence does not make it a part of its own line
        parts = [(at + m.start(), at + m.end()) for m in SENTENCE.finditer(line) if not m.group().isspace()]
        if len(parts) > 1:
            spans += parts
        for a, b in spans:
            words = text[a:b].lower().split()
            if len(words) >= MIN_WORDS:
                out.append((a, b, b" ".join(words)))
        at += len(line) + 1
    return out


def digests(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = units(text)
    raw = b"".join(xxhash.xxh3_128_digest(u) for _, _, u in found)
    k = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    # a position is the unit's number: units are ordered by start, a line before its sentences
    return k[:, 0], k[:, 1], np.arange(len(found))


def dedup_units(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text without later repeats, and n_bytes,
    n_units, n_removed (units), removed (original byte spans)."""
    with_found = R.attached(docs, R.later_positions(docs, digests))
    names = [c for c in docs.columns if c not in RESULT]
    extra = "n_bytes long, n_units long, n_removed long, removed array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)

    def run(batches):
        for b in batches:
            texts, stats = [], []
            for t, p in zip(b.column("text").to_pylist(), b.column("__llm_pos").to_pylist(), strict=True):
                raw = (t or "").encode()
                found = units(raw)
                gone = [found[i] for i in np.frombuffer(p or b"", np.uint32)]
                spans = R.merged([(x, y) for x, y, _ in gone])
                kept = R.without(raw, spans)
                texts.append(t if t is None else kept.decode())
                stats.append((len(raw), len(found), len(gone), [{"start": x, "end": y} for x, y in spans],
                              hashlib.sha256(kept).hexdigest()))
            cols = [pa.array(texts, b.column("text").type) if n == "text" else b.column(n) for n in names]
            n = list(zip(*stats, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*cols, *(pa.array(n[i], pa.int64()) for i in range(3)), pa.array(n[3], span), pa.array(n[4], pa.string())],
                names=[*names, *RESULT])

    return with_found.select(*names, "__llm_pos").mapInArrow(run, f"{types}, {extra}")


def report(docs: DataFrame) -> DataFrame:
    out = dedup_units(docs.select("doc_id", "text"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select("doc_id", "n_bytes", "n_units", "n_removed", spans.alias("removed"), "kept_sha256")
