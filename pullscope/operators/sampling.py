"""Samples and heads: L3, L4.

A seeded sample is the ``n`` rows with the smallest hash of (key, seed): the same rows for any
partitioning or cluster size, computed as a top-k (``TakeOrderedAndProject``), not a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_n(df: DataFrame, n: int = 20, seed: int = 42, key: Sequence[str] = ("id",)) -> DataFrame:
    """L4: up to ``n`` rows chosen by ``sha1(seed || key)`` order (deterministic).

    The rows differ from pandas' random generator (documented); the size and determinism
    are what the reference relies on.
    """
    h = F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")


def head_in_order(df: DataFrame, n: int = 20, order: Sequence[str] = ("row_ord",)) -> DataFrame:
    """L3: the first ``n`` rows in stored order (``sources.tables.with_stored_order``)."""
    return df.orderBy(*order).limit(n)
