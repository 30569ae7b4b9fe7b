"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are documents, columns are word 5-gram hashes;
the result is the connected components of all pairs with Jaccard similarity
of at least 0.75.

1. Column order.  A fixed array of ``CELLS`` counters, summed over all
   documents, gives each column a class (log2 of the count of its cell).
   Columns are ordered by (class, hash), rare ones first.  Any order gives the
   same result; this one keeps passages that many documents share last.
2. Size bounds.  A partner must hold at least 0.75 n of a row's n columns, so
   two linked rows meet in one of the first n - ceil(0.75 n) + 1 columns of
   each.  Only those entries are multiplied.
3. Blocks.  The entries travel as raw arrays, one row per batch of documents
   and block of columns.  A block forms the candidates of each of its
   columns and discards pairs below the bounds on size and position.
   Instead of all pairs of a column it first pairs every row with the
   column's hub: the row in which the column stands first, which has the
   fewest rarer columns of its own and so is likest to the others.
   Documents with equal columns are linked by a 128-bit digest of them.
4. Each row is compared with the hub it shares most columns with; the
   overlap is accumulated exactly over the full rows.
   Rows linked so far fall into components.  While the columns would still
   form very many pairs of different components and rounds still link rows,
   each row is compared with one more row of a column, drawn by hash.
   Last, all pairs of different components that are left are formed; those
   whose common columns so far allow it are verified, so no link between
   components is lost.  These pairs can be many more than the rows, and a
   row moves once for each, so sketches of the rows go first: bit arrays
   from which most that two rows have in common follows.  Full rows move for
   the pairs only that could be linked by these.

Rows with equal columns in one batch are one row.  Null or empty text and
white space only: no columns, linked with nothing.  Fewer than five words:
the whole sequence is the one column.  Rows that share a doc_id are one node
(each is reported with its own size); null doc_ids share one node.  An empty
table gives no rows; other columns are ignored (``keep_one_each`` keeps them),
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import (hashed_words, joined, mix, prepare, saved, scatter, shuffle_blocks, sized, slices, text_column,
                                 windows, with_bytes)
from histlake.llm.components import components

SHINGLE = 5
NULL_ID = (1 << 63) - 1       # the node of rows without doc_id, never the smallest of a group
PERCENT = 75                 # Jaccard threshold
CELLS = 1 << 22
CHUNK = 1 << 14              # counters that travel in one row
CLASS_SHIFT = np.uint64(59)
FLAG_BITS = 1 << 23
SKETCH_BITS = 4              # per column, at least
STAR_ROUNDS = 8              # of drawn partners, while more than
PAIRS_PER_ROW = 200          # pairs per row of open columns are left to form
ROUND_SHARE = 0.05           # and the last round has linked this share of its pairs
BROADCAST_ROWS = 1_000_000   # rows of two longs (16 MB); larger tables are joined by a shuffle


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Column hashes of all texts end to end (with repeats), and how many each has."""
    h, counts = hashed_words([t.lower() for t in texts])
    key, doc = windows(h, counts, SHINGLE)
    key, doc = key[doc >= 0], doc[doc >= 0]
    per = np.bincount(doc, minlength=len(counts))
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        start = counts.cumsum() - counts
        whole = np.array([xxhash.xxh64_intdigest(h[start[i]:start[i] + counts[i]].tobytes()) for i in short], np.uint64)
        at = (per.cumsum() - per)[short]
        key = np.insert(key, at, whole)
        per[short] = 1
    return key, per


def column_classes(docs: DataFrame) -> np.ndarray:
    """Class of every cell; a fixed number of bytes whatever the input."""
    def count(batches):
        total = np.zeros(CELLS, np.uint32)
        for b in slices(batches):
            key, _ = shingles(text_column(b))
            cell, times = np.unique(key & np.uint64(CELLS - 1), return_counts=True)
            total[cell.astype(np.int64)] += times.astype(np.uint32)
        chunks = [(i, np.minimum(part, 255).astype(np.uint8)) for i, part in enumerate(total.reshape(-1, CHUNK)) if part.any()]
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in chunks], pa.int32()),
                                              pa.array([p.tobytes() for _, p in chunks], pa.binary())], names=["chunk", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
                total.setdefault(i, np.zeros(CHUNK, np.int64))
                total[i] += np.frombuffer(raw, np.uint8)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([np.log2(t + 1).astype(np.uint8).tobytes() for t in total.values()], pa.binary())], names=["chunk", "counts"])

    ddl = "chunk int, counts binary"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = with_bytes(docs).mapInArrow(count, ddl).repartition(parts, "chunk").mapInArrow(add, ddl)
    out = np.zeros(CELLS, np.uint8)
    for r in summed.collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.uint8)
    return np.minimum(out, 31)


def rows_of(texts: list[bytes], classes: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct columns of each text: class in the top 5 bits,
    hash in the other 59."""
    key, per = shingles(texts)
    cls = classes[(key & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    key = (cls << CLASS_SHIFT) | (key >> np.uint64(5))
    at = 0
    for n in per:
        own = np.sort(key[at:at + n])
        at += n
        yield own[np.r_[True, own[1:] != own[:-1]]] if n else own


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


PART = pa.schema([("block", pa.int32()), ("col", pa.binary()), ("doc", pa.binary()), ("n", pa.binary()), ("pos", pa.binary()), ("sig", pa.binary())])
FOUND = pa.schema([("kind", pa.int32()), ("col", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("rep", pa.int64()), ("sig", pa.int64())])
FOUND_DDL = "kind int, col long, doc long, n int, pos int, rep long, sig long"
POSTING, DOCUMENT = 0, 1


def _entries(docs: DataFrame, classes, blocks: int) -> DataFrame:
    def rows(batch) -> Iterator[tuple]:
        ids = np.array([NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()], np.int64)
        sizes, same = np.zeros(len(ids), np.int64), {}
        rep, cols, owner, pos = ids.copy(), [], [], []
        sig = np.zeros((len(ids), 2), np.int64)
        sets = list(rows_of(text_column(batch), classes.value))
        for i in np.argsort(ids, kind="stable").tolist():
            own = sets[i]
            sizes[i] = len(own)
            if not len(own):
                continue
            digest = xxhash.xxh3_128_digest(own.tobytes())
            sig[i] = np.frombuffer(digest, np.int64)
            first = same.setdefault(digest, ids[i])
            if first != ids[i]:
                rep[i] = first
                continue
            p = prefix_length(len(own))
            cols.append(own[:p])
            owner.append(np.full(p, i))
            pos.append(np.arange(p))
        for b, part in scatter((mix(ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64), ids, sizes.astype(np.uint32), rep, sig):
            yield (-1 - b, part[2], part[0], part[1], b"", part[3])
        if cols:
            col, own, at = mix(np.concatenate(cols)), np.concatenate(owner), np.concatenate(pos)
            block = (col % np.uint64(blocks)).astype(np.int64)
            yield from ((b, *part, b"") for b, part in scatter(
                block, (col >> np.uint64(32)).astype(np.uint32), ids[own], sizes[own].astype(np.uint32), at.astype(np.uint32)))

    def run(batches):
        for b in slices(batches):
            got = list(rows(b))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), PART, strict=True)], schema=PART)

    narrow = with_bytes(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
    return narrow.mapInArrow(run, "block int, col binary, doc binary, n binary, pos binary, sig binary")


def packed(own: np.ndarray) -> bytes:
    """A full row as bytes: its sorted distinct columns."""
    return own.astype("<u8").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def sketch(own: np.ndarray) -> bytes:
    """A row's number of columns, and a bit for each of them: an array of at
    least ``SKETCH_BITS`` times their number, a power of two."""
    size = 1 << max(6, (SKETCH_BITS * len(own) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(own & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.uint32(len(own)).tobytes() + np.packbits(bits, bitorder="little").tobytes()


def may_be_linked(a: bytes, b: bytes) -> bool:
    """Do the sketches of two rows allow a link?  Each bit of one that the
    other lacks stands for a column at least that is not common to both."""
    n_a, n_b = (int.from_bytes(x[:4], "little") for x in (a, b))
    x, y = np.frombuffer(a, "<u8", offset=4), np.frombuffer(b, "<u8", offset=4)
    while len(x) != len(y):      # both are powers of two; a column's bit in half the array is that in either half
        if len(x) > len(y):
            x = x[:len(x) // 2] | x[len(x) // 2:]
        else:
            y = y[:len(y) // 2] | y[len(y) // 2:]
    both = min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))
    return both > 0 and (100 + PERCENT) * both >= PERCENT * (n_a + n_b)


def within_bounds(n_a, p_a, n_b, p_b):
    """Can two rows that first meet at these positions be linked at all?"""
    need = -(-PERCENT * (n_a + n_b) // (100 + PERCENT))
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * small >= PERCENT * large) & (n_a - p_a >= need) & (n_b - p_b >= need)


def _with_partner(col, doc, n, pos, width: int = 32) -> np.ndarray:
    """Rows that the bounds let be linked with another row of their column;
    in columns of more than ``width`` rows, those that could be linked with
    the smallest row of at least 0.75 of their size."""
    group = np.r_[False, col[1:] != col[:-1]].cumsum() if len(col) else np.zeros(0, np.int64)
    count = np.bincount(group) if len(col) else np.zeros(0, np.int64)
    keep = np.repeat(count > width, count)
    wide = np.flatnonzero(keep)
    sizes = np.sort((group[wide] << 32) + n[wide])
    least = sizes[np.searchsorted(sizes, (group[wide] << 32) + -(-PERCENT * n[wide] // 100))] & 0xFFFFFFFF
    keep[wide] = n[wide] - pos[wide] >= -(-PERCENT * (n[wide] + least) // (100 + PERCENT))
    for step in range(1, min(width, int(count.max(initial=0)))):
        i = np.flatnonzero(col[step:] == col[:-step])
        i = i[within_bounds(n[i], pos[i], n[i + step], pos[i + step]) & (doc[i] != doc[i + step])]
        keep[i] = keep[i + step] = True
    return keep


def _candidates(t: pa.Table) -> pa.Table:
    """Columns that two rows or more share; each row with the hub of its
    column, if the bounds let them be linked."""
    block = t["block"][0].as_py()
    doc, n = joined(t["doc"], np.int64), joined(t["n"], np.uint32).astype(np.int64)
    if block < 0:
        rep, none = joined(t["col"], np.int64), np.zeros(len(doc), np.int64)
        sig = joined(t["sig"], np.int64).reshape(-1, 2)
        return pa.table([pa.array(x, f.type) for x, f in zip((none + DOCUMENT, sig[:, 0], doc, n, none, rep, sig[:, 1]), FOUND, strict=True)],
                        schema=FOUND)
    col, pos = joined(t["col"], np.uint32).astype(np.int64), joined(t["pos"], np.uint32).astype(np.int64)
    order = np.lexsort((doc, pos, col))          # the hub is a column's first row
    col, doc, n, pos = col[order], doc[order], n[order], pos[order]
    shared = np.zeros(len(col), bool)
    shared[1:] |= col[1:] == col[:-1]
    shared[:-1] |= col[1:] == col[:-1]
    col, doc, n, pos = col[shared], doc[shared], n[shared], pos[shared]
    partner = _with_partner(col, doc, n, pos)
    col, doc, n, pos = col[partner], doc[partner], n[partner], pos[partner]
    new = np.r_[True, col[1:] != col[:-1]] if len(col) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(col)), 0)) if len(col) else np.zeros(0, np.int64)
    ok = within_bounds(n, pos, n[first], pos[first]) & (doc != doc[first])
    rep = np.where(ok, doc[first], doc)
    alone = ~ok & (np.arange(len(col)) != first) & (doc != doc[first])    # not compared with the column's first row
    key = (np.int64(block) << 32) | col
    return pa.table([pa.array(x, f.type) for x, f in zip((np.zeros(len(col), np.int64), key, doc, n, pos, rep, alone.astype(np.int64)), FOUND, strict=True)], schema=FOUND)


def _full_rows(docs: DataFrame, wanted: DataFrame, classes, form=packed) -> DataFrame:
    """doc, cols: the full rows of the wanted documents, or another form of
    them.  They are picked by a bit array of fixed size, so texts are not
    shuffled; a few more rows than wanted do no harm."""
    spark = docs.sparkSession
    cell = lambda c: F.pmod(F.xxhash64(c), F.lit(FLAG_BITS))
    marks = wanted.select((cell("doc") + 1).alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    flags = np.zeros(FLAG_BITS // 8, np.uint8)
    for r in marks:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        at = (r["bucket"] - 1) * 4096
        flags[at:at + 4096] = part
    bits = spark.sparkContext.broadcast(np.unpackbits(flags, bitorder="little"))

    def run(batches):
        for b in slices(batches):
            b = b.filter(pa.array(bits.value[b.column("cell").to_numpy()].astype(bool)))
            if b.num_rows:
                sets = [form(s) for s in rows_of(text_column(b), classes.value)]
                yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(sets, pa.binary())], names=["doc", "cols"])

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    keyed = with_bytes(docs.withColumn("doc", doc).withColumn("cell", cell("doc")), "doc", "cell")
    return keyed.mapInArrow(run, "doc long, cols binary")


def _by_sketches(pairs: DataFrame, docs: DataFrame, classes) -> DataFrame:
    """The pairs (a, b) that the sketches of their rows allow to be linked."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    wanted = saved(ends, "ngram-ends")
    # one of the sketches moves for each pair; those of rows that are in no pair stay behind
    rows = saved(_full_rows(docs, wanted, classes, sketch).join(sized(wanted, BROADCAST_ROWS), "doc", "left_semi"), "ngram-sketches")

    def allowed(batches):
        for b in slices(batches):
            keep = [may_be_linked(x, y) for x, y in zip(b.column("cols_a").to_pylist(), b.column("cols_b").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (rows.select(F.col("doc").alias(c), F.col("cols").alias(f"cols_{c}")) for c in ("a", "b"))
    met = left.join(sized(pairs, BROADCAST_ROWS), "a").join(right, "b").select("a", "b", "cols_a", "cols_b")
    return met.mapInArrow(allowed, "a long, b long").distinct()


def _linked(pairs: DataFrame, docs: DataFrame, classes) -> DataFrame:
    """The pairs (a, b) whose accumulated overlap reaches the threshold."""
    def overlap(batches):
        for b in slices(batches, 500):
            keep = []
            for x, y in zip(b.column("cols_a").to_pylist(), b.column("cols_b").to_pylist(), strict=True):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = _full_rows(docs, pairs.select(F.col("a").alias("doc")), classes).select(F.col("doc").alias("a"), F.col("cols").alias("cols_a"))
    right = _full_rows(docs, pairs.select(F.col("b").alias("doc")), classes).select(F.col("doc").alias("b"), F.col("cols").alias("cols_b"))
    # many rows share one partner b: each row moves once, b once, not once per row
    left = left.join(sized(pairs, BROADCAST_ROWS), "a")
    return left.join(right, "b").select("a", "b", "cols_a", "cols_b").mapInArrow(overlap, "a long, b long")


def _open_rows(postings: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows, with their components, of the columns that hold rows of more
    than one component."""
    part = lambda df, c: df.join(
        parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part")), c, "left").withColumn(f"{c}_part", F.coalesce(f"{c}_part", c))
    parts = sized(parts, BROADCAST_ROWS)
    # a column is settled if each of its rows is in one component with its first row
    open_columns = part(part(postings.select("col", "doc", "rep", "sig"), "doc"), "rep").where(
        "sig = 1 or doc_part <> rep_part").select("col").distinct()
    open_columns = saved(open_columns, "ngram-open")
    at = part(postings.select("col", "doc", "n", "pos").join(sized(open_columns, BROADCAST_ROWS), "col", "left_semi"), "doc")
    return saved(at.withColumnRenamed("doc_part", "component"), "ngram-parts")


def _bounds(a: str, b: str):
    """Rows of different components that the bounds let be linked."""
    need = F.ceil(F.lit(PERCENT) * (F.col(f"n_{a}") + F.col(f"n_{b}")) / (100 + PERCENT))
    return ((F.col(f"component_{a}") != F.col(f"component_{b}"))
            & (100 * F.least(f"n_{a}", f"n_{b}") >= PERCENT * F.greatest(f"n_{a}", f"n_{b}"))
            & (F.col(f"n_{a}") - F.col(f"pos_{a}") >= need) & (F.col(f"n_{b}") - F.col(f"pos_{b}") >= need))


def _many_pairs(at: DataFrame) -> bool:
    """Would the columns form many more pairs of different components than
    they have rows?  Counted from their sizes, no pair is formed."""
    sizes = at.groupBy("col", "component").agg(F.count("*").cast("double").alias("k"))
    pairs = sizes.groupBy("col").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same"))
    r = pairs.agg(F.sum("k").alias("rows"), (F.sum(F.col("k") * F.col("k") - F.col("same")) / 2).alias("pairs")).first()
    return (r["pairs"] or 0) > PAIRS_PER_ROW * (r["rows"] or 0)


def _star_round(at: DataFrame, seed: int) -> DataFrame:
    """Each row with one row of a column of it, drawn by hash, that is in
    another component."""
    drawn = F.xxhash64(F.lit(seed), "doc")
    hub = at.groupBy("col").agg(F.min_by(F.struct("doc", "n", "pos", "component"), drawn).alias("h")).select(
        "col", *(F.col(f"h.{c}").alias(f"{c}_b") for c in ("doc", "n", "pos", "component")))
    x = at.select("col", *(F.col(c).alias(f"{c}_a") for c in ("doc", "n", "pos", "component")))
    near = x.join(hub, "col").where(_bounds("a", "b"))
    return near.groupBy(F.col("doc_a").alias("a")).agg(F.min_by("doc_b", F.xxhash64(F.lit(seed), "doc_b")).alias("b"))


def _cross_pairs(at: DataFrame, several: DataFrame) -> DataFrame:
    """Pairs within the bounds whose rows are in different components and
    whose common columns do not rule a link out.

    Of all columns that two rows have in common, those within the bounds come
    first in both.  So what they have in common is at most the number of
    these and the columns behind the last of them.  This is not said of the
    ``several`` documents that have more than one text."""
    x = at.select("col", *(F.col(c).alias(f"{c}_a") for c in ("doc", "n", "pos", "component")))
    y = at.select("col", *(F.col(c).alias(f"{c}_b") for c in ("doc", "n", "pos", "component")))
    met = x.join(y, "col").where(_bounds("a", "b") & (F.col("component_a") < F.col("component_b")))
    met = met.groupBy(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).agg(
        F.count("*").alias("common"), *(f(c).alias(c) for f, c in ((F.max, "n_a"), (F.max, "n_b"), (F.max, "pos_a"), (F.max, "pos_b"))))
    most = F.col("common") + F.greatest(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) - 1
    may = (100 + PERCENT) * most >= PERCENT * (F.col("n_a") + F.col("n_b"))
    for c in ("a", "b"):
        met = met.join(several.select(F.col("doc").alias(f"several_{c}")), F.col(c) == F.col(f"several_{c}"), "left")
    return met.where(may | F.col("several_a").isNotNull() | F.col("several_b").isNotNull()).select("a", "b")


def similar_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark = prepare(docs.sparkSession)
    classes = spark.sparkContext.broadcast(column_classes(docs))
    blocks = shuffle_blocks(spark)
    found = saved(_entries(docs, classes, blocks).groupBy("block").applyInArrow(_candidates, FOUND_DDL), "ngram-columns")
    postings, info = found.where(F.col("kind") == POSTING), found.where(F.col("kind") == DOCUMENT)

    # equal rows: of a batch by their first document, of the corpus by digest
    leads = info.where("rep = doc and n > 0").select("doc", F.col("col").alias("sig0"), F.col("sig").alias("sig1"))
    firsts = leads.groupBy("sig0", "sig1").agg(F.min("doc").alias("first"), F.count("*").alias("size")).where("size > 1")
    copies = saved(leads.join(firsts.drop("size"), ["sig0", "sig1"]).where("doc <> first").select(
        F.col("doc").alias("a"), F.col("first").alias("b"), "sig0", "sig1").distinct(), "ngram-copies")
    same = info.where("rep <> doc").select(F.col("doc").alias("a"), F.col("rep").alias("b")).union(copies.select("a", "b"))
    # a node whose rows are all copies is left to their first documents; one with a text of its own is not
    copied = copies.groupBy(F.col("a").alias("copy")).agg(F.count("*").alias("n_copies"))
    texts = leads.select("doc", "sig0", "sig1").join(
        sized(copies.select(F.col("a").alias("doc")).distinct(), BROADCAST_ROWS), "doc", "left_semi").distinct().groupBy("doc").agg(
        F.count("*").alias("n_texts"))
    gone = saved(copied.join(texts, F.col("copy") == F.col("doc")).where("n_copies = n_texts").select("copy"), "ngram-gone")

    met = postings.where("rep <> doc").groupBy("doc", "rep").agg(F.count("*").alias("columns"))
    stars = met.groupBy(F.col("doc").alias("a")).agg(F.max_by("rep", F.struct("columns", -F.col("rep"))).alias("b"))
    stars = saved(stars.join(gone, F.col("a") == F.col("copy"), "left_anti"), "ngram-stars")
    links = saved(same.union(_linked(stars, docs, classes)), "ngram-links")
    left_out = lambda df: df.join(gone, F.col("a") == F.col("copy"), "left_anti").join(
        gone, F.col("b") == F.col("copy"), "left_anti").select("a", "b")
    at = _open_rows(postings, components(links))
    for seed in range(STAR_ROUNDS):
        if not _many_pairs(at):
            break
        # rows that are alike mostly meet in a drawn one: joins components at one pair a row
        pairs = saved(left_out(_star_round(at, seed)), "ngram-stars")
        found_now = saved(_linked(pairs, docs, classes), "ngram-links")
        links = links.union(found_now)
        at = _open_rows(postings, components(links))
        if found_now.count() < ROUND_SHARE * pairs.count():
            break
    several = saved(info.where("n > 0").groupBy("doc").agg(F.count("*").alias("rows")).where("rows > 1").select("doc"), "ngram-several")
    cross = saved(left_out(_cross_pairs(at, several)), "ngram-cross")
    more = _linked(saved(_by_sketches(cross, docs, classes), "ngram-allowed"), docs, classes)
    whole = components(links.union(more))

    out = info.join(whole.withColumnRenamed("node", "doc"), "doc", "left")
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(real("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce(real("component"), real("doc")).alias("component_id"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each group (its smallest doc_id); rows without a
    doc_id are kept."""
    gone = similar_groups(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
