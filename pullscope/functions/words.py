"""H5 for long texts: words counted on Arrow buffers.

``scalars.word_count`` makes every word a string; texts such as PR bodies are counted here, a bounded slice of
bytes at a time, without making any. Both count what Python's ``str.split()`` counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pullscope.functions.scalars import _WHITE_SPACE, col_
from pullscope.session import ship

#: Bytes looked at in one step; a longer text is a step of its own.
STEP = 1 << 22
#: Rows and bytes of an Arrow batch at most.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 24}

_WHITE = [c.encode() for c in " " + _WHITE_SPACE]
_ONE = np.isin(np.arange(256), [c[0] for c in _WHITE if len(c) == 1])
#: Wide white space by its bytes, and the bytes that such a character starts with.
_WIDE = {n: np.array(sorted(int.from_bytes(c, "big") for c in _WHITE if len(c) == n)) for n in (2, 3)}
_LEADS = {n: sorted({c[0] for c in _WHITE if len(c) == n}) for n in (2, 3)}


def _is_white(x: np.ndarray) -> np.ndarray:
    """Which bytes of whole UTF-8 texts belong to white space."""
    white = _ONE[x]
    if x.max() < 0x80:
        return white
    for n, codes in _WIDE.items():
        for lead in _LEADS[n]:
            at = np.flatnonzero(x == lead)
            at = at[at + n <= len(x)]
            code = np.zeros(len(at), np.int64)
            for i in range(n):
                code = code << 8 | x[at + i]
            at = at[np.isin(code, codes)]
            for i in range(n):
                white[at + i] = True
    return white


def count_words(texts: pa.Array) -> np.ndarray:
    """Number of words of each text; null and empty texts have none."""
    out = np.zeros(len(texts), np.int64)
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + STEP, "right")) - 1)
        if ends[hi] > ends[lo]:
            x = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[hi] - ends[lo]), int(ends[lo]))
            cuts = ends[lo:hi + 1] - ends[lo]
            word = ~_is_white(x)
            starts = word.copy()
            starts[1:] &= ~word[:-1]
            first = cuts[:-1][cuts[1:] > cuts[:-1]]  # a word that starts a text starts there, whatever the text before ends with
            starts[first] = word[first]
            out[lo:hi] = np.diff(np.searchsorted(np.flatnonzero(starts), cuts))
        lo = hi
    return out


def word_count_long(spark: SparkSession, text) -> Column:
    """H5 as ``scalars.word_count``, for long texts."""
    ship(spark)
    for name, most in BATCH.items():
        spark.conf.set(name, str(most))

    @F.arrow_udf("long")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array(count_words(texts))

    return words(F.coalesce(col_(text), F.lit("")))
