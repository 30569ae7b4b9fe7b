"""Helpers for vector columns inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """True for a vector that is not null and holds finite entries only."""
    return F.col(column).isNotNull() & F.forall(
        F.transform(column, lambda c: c.cast("double")),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The list cells of a column as matrices, one per length of vector:
    the row numbers and their rows."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        at = (ends[rows] - dim)[:, None] + np.arange(dim)[None, :]
        yield rows, values[at].reshape(len(rows), int(dim))
