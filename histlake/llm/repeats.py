"""Global first occurrences of digests, in blocks.

A batch of documents yields entries (128-bit digest, document, position).
Equal digests of a batch are first reduced to their earliest entry, so a
digest that occurs everywhere reaches its block once per batch.  Entries travel as raw
arrays, one row per batch and block of the digest space; each block finds the
earliest document and position of every digest and hands back all others.

Documents rank by (doc_id, 64-bit hash of the text); a null doc_id ranks
first.  This pair is also a document's identity when its positions come back:
rows that share both are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import joined, mix, prepare, scatter, shuffle_blocks, slices, text_column, with_bytes

NULL_ID = -(1 << 63)
PART = pa.schema([("block", pa.int32()), ("k0", pa.binary()), ("k1", pa.binary()), ("doc", pa.binary()),
                  ("tag", pa.binary()), ("pos", pa.binary())])
PART_DDL = "block int, k0 binary, k1 binary, doc binary, tag binary, pos binary"
LATER = pa.schema([("block", pa.int32()), ("doc", pa.binary()), ("tag", pa.binary()), ("pos", pa.binary())])
LATER_DDL = "block int, doc binary, tag binary, pos binary"

#: text -> (digest halves, position of each entry)
Units = Callable[[bytes], tuple[np.ndarray, np.ndarray, np.ndarray]]


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with the identity that positions refer to."""
    return docs.withColumns({
        "__llm_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
        "__llm_tag": F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))})


SEED = 42                    # fixed value: the seed of Spark's xxhash64


def text_tag(text: bytes) -> int:
    """The same hash as ``__llm_tag``, without sign."""
    return xxhash.xxh64_intdigest(text, SEED)


def earliest(k0, k1, doc, tag, pos) -> tuple[np.ndarray, np.ndarray]:
    """Order by digest and rank, and a mask of the entries that are not at
    their digest's earliest place."""
    order = np.lexsort((pos, tag, doc, k1, k0))
    a = [x[order] for x in (k0, k1, doc, tag, pos)]
    new = np.ones(len(order), bool)
    new[1:] = (a[0][1:] != a[0][:-1]) | (a[1][1:] != a[1][:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    same_place = (a[2] == a[2][first]) & (a[3] == a[3][first]) & (a[4] == a[4][first])
    return order, ~same_place


def _block_of(doc: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(doc.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def entries(docs: DataFrame, units: Units, blocks: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = [NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()]
        parts = []
        for i, t in zip(ids, text_column(batch), strict=True):
            k0, k1, pos = units(t)
            if len(pos):
                parts.append((k0, k1, np.full(len(pos), i, np.int64), np.full(len(pos), text_tag(t), np.uint64),
                              pos.astype(np.int64)))
        if not parts:
            return
        k0, k1, doc, tag, pos = (np.concatenate(c) for c in zip(*parts, strict=True))
        order, later = earliest(k0, k1, doc, tag, pos)
        kept, gone = order[~later], order[later]
        pos = pos.astype(np.uint32)
        for b, cols in scatter((k0[kept] % np.uint64(blocks)).astype(np.int64), *(x[kept] for x in (k0, k1, doc, tag, pos))):
            yield (b, *cols)
        for b, cols in scatter(_block_of(doc[gone], blocks), *(x[gone] for x in (doc, tag, pos))):
            yield (-1 - b, b"", b"", *cols)

    def run(batches):
        for b in slices(batches):
            got = list(rows(b))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), PART, strict=True)],
                                                 schema=PART)

    narrow = with_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    return narrow.mapInArrow(run, PART_DDL)


def scattered(blocks: int, doc: np.ndarray, tag: np.ndarray, *columns: np.ndarray, schema: pa.Schema = LATER) -> pa.Table:
    got = [(b, *cols) for b, cols in scatter(_block_of(doc, blocks), doc, tag, *columns)]
    return pa.table([pa.array([g[i] for g in got], f.type) for i, f in enumerate(schema)], schema=schema)


def later_positions(docs: DataFrame, units: Units) -> DataFrame:
    """doc_key, text_tag, positions (little-endian 32-bit): every entry whose
    digest occurs earlier."""
    prepare(docs.sparkSession)
    blocks = shuffle_blocks(docs.sparkSession)

    def find(t: pa.Table) -> pa.Table:
        doc, tag, pos = joined(t["doc"], np.int64), joined(t["tag"], np.uint64), joined(t["pos"], np.uint32)
        if t["block"][0].as_py() >= 0:
            order, later = earliest(joined(t["k0"], np.uint64), joined(t["k1"], np.uint64), doc, tag, pos)
            gone = order[later]
            doc, tag, pos = doc[gone], tag[gone], pos[gone]
        return scattered(blocks, doc, tag, pos)

    later = entries(docs, units, blocks).groupBy("block").applyInArrow(find, LATER_DDL)
    return by_document(later)


def by_document(later: DataFrame, columns: tuple[str, ...] = ("pos",)) -> DataFrame:
    """One row per document with the raw 32-bit arrays of its entries."""
    schema = pa.schema([("doc_key", pa.int64()), ("text_tag", pa.int64()), *((c, pa.binary()) for c in columns)])

    def gather(t: pa.Table) -> pa.Table:
        doc, tag = joined(t["doc"], np.int64), joined(t["tag"], np.uint64)
        values = [joined(t[c], np.uint32) for c in columns]
        order = np.lexsort((*reversed(values), tag, doc))
        doc, tag, values = doc[order], tag[order], [v[order] for v in values]
        if not len(doc):
            return schema.empty_table()
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
        end = np.r_[new[1:], len(doc)]
        return pa.table([pa.array(doc[new]), pa.array(tag[new].view(np.int64)),
                         *(pa.array([v[a:b].tobytes() for a, b in zip(new, end, strict=True)], pa.binary()) for v in values)],
                        schema=schema)

    return later.groupBy("block").applyInArrow(
        gather, "doc_key long, text_tag long, " + ", ".join(f"{c} binary" for c in columns))


def attached(docs: DataFrame, found: DataFrame) -> DataFrame:
    return joined_on_key(keyed(docs), found)


def joined_on_key(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Keyed documents with their entries as ``__llm_<column>`` (null without any);
    the small side is hashed."""
    right = found.withColumnsRenamed({c: f"__llm_{c}" for c in found.columns if c not in ("doc_key", "text_tag")})
    right = right.withColumnsRenamed({"doc_key": "__llm_doc", "text_tag": "__llm_tag"}).hint("SHUFFLE_HASH")
    return docs.join(right, ["__llm_doc", "__llm_tag"], "left")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with overlapping or touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])
