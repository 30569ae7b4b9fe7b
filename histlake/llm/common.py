"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


#: What Python workers get: they import this package, and give memory back
#: that a batch has used (several of them share an executor).
WORKER_SETTINGS = {"MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_MMAP_THRESHOLD_": "262144",
                   "ARROW_DEFAULT_MEMORY_POOL": "system", "OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"}
BATCH_BYTES = 4 << 20        # of an Arrow batch: texts may be very long


def prepare(spark: SparkSession) -> SparkSession:
    """Set up Python workers.  They import this package from where the driver
    did; on a cluster whose executors do not see that folder, install the
    package there or send it with ``SparkContext.addPyFile``."""
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, PACKAGE_ROOT]))
    for name, value in WORKER_SETTINGS.items():
        environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and keeps one copy of the work
    for several readers."""
    from histlake.session import checkpoint_root

    path = f"{checkpoint_root(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """A stored table as a broadcast side if it has at most ``rows`` rows;
    else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffle_blocks(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of key-space blocks: a few per shuffle partition, the setting
    that a cluster sizes with its input."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts as UTF-8 bytes; null counts as the empty text."""
    return [x or b"" for x in batch.column(name).to_pylist()]


def with_bytes(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and the text as binary, under the name ``text``."""
    return docs.select(*keep, F.col(text).cast("binary").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift multiply), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """word bytes -> 64-bit hash; holds at most ``limit`` words."""

    def __init__(self, limit: int = 50_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORDS = WordHashes()


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and the word count of each.
    Words are maximal runs of bytes other than the six ASCII white spaces,
    which is how ``bytes.split`` cuts."""
    split = [t.split() for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    parts = [WORDS.of(w) for w in split]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def windows(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words that stays inside one text, and the
    index of its text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, np.uint64)
        for i in range(size):
            acc = acc * GOLDEN + h[i:i + n]
            acc ^= acc >> np.uint64(29)
        acc = mix(acc)
    inside = doc[:n] == doc[size - 1:]
    return acc, np.where(inside, doc[:n], -1)


def scatter(block: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The entries of each block, column by column, as raw bytes."""
    order = np.argsort(block, kind="stable")
    ids, first = np.unique(block[order], return_index=True)
    cut = [np.split(c[order], first[1:]) for c in columns]
    for i, b in enumerate(ids):
        yield int(b), [c[i].tobytes() for c in cut]


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """Raw-byte cells of a column as one array."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)
