"""Shared helpers of the vector operators: Arrow lists as numpy matrices, and bounded block products."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.text import ship

#: Rows of each side that meet in one group of a block product.
BLOCK_ROWS = 1024


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length among the lists of a column: the places of the rows of that length, and these
    rows as a float64 matrix. Null components become NaN; null lists are in no matrix."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(lengths, 0))
    for n in np.unique(lengths[lengths >= 0]):
        at = np.flatnonzero(lengths == n)
        yield at, flat[(ends[at] - n)[:, None] + np.arange(n)]


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row's float64 bytes."""
    return [r.tobytes() for r in np.ascontiguousarray(rows)]


def unpacked(column: pa.Array | pa.ChunkedArray, n: int | None = None) -> np.ndarray:
    """The matrix of packed rows of one length (``n``: that length, where the column may be empty)."""
    cells = column.to_pylist()
    width = len(cells[0]) // 8 if cells else n or 0
    return np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), width)


def block_product(left: DataFrame, right: DataFrame, keys: list[str], row: str, function: Callable, schema: str,
                  rows: int = BLOCK_ROWS, right_rows: int | None = None) -> DataFrame:
    """Apply ``function(key, left table, right table)`` to every pair of blocks of rows that share ``keys``.

    A key's rows are dealt by a hash of ``row`` into blocks of about ``rows`` (``right_rows`` on the right), and
    each block of the left meets each block of the right: no group is larger than two blocks, however many rows
    a key has, and each row is sent once per block of the other side. ``left`` and ``right`` are read twice
    (their counts first), so they should be stored tables.
    """
    ship(left.sparkSession)

    def blocks(df: DataFrame, name: str, most: int) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("int").alias(name))

    sizes = blocks(left, "_nl", rows).join(blocks(right, "_nr", right_rows or rows), keys)

    def dealt(df: DataFrame, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        # aliased, as both sides may come from one table
        return (df.join(sizes, keys).withColumn(own_block, F.pmod(F.xxhash64(row), F.col(own)).cast("int"))
                .withColumn(other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select(*[F.col(c).alias(c) for c in (*df.columns, "_bl", "_br")]))

    by = [*keys, "_bl", "_br"]
    a = dealt(left, "_nl", "_nr", "_bl", "_br").groupBy(*by)
    b = dealt(right, "_nr", "_nl", "_br", "_bl").groupBy(*by)
    return a.cogroup(b).applyInArrow(function, schema)
