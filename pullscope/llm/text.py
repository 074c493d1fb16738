"""Shared helpers: Arrow text buffers, vectorised words and hashes, stored stage tables.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text. They are located and hashed on the
raw Arrow buffer of a batch with numpy, a bounded slice of rows at a time, so that a task's
memory does not grow with its partition.

``word_hashes`` mixes a word's bytes into 64 bits, eight at a time and each step keyed by what came
before: equal words have equal hashes, and no pattern of letters makes different words share one (the chance is
about 2**-64 per pair). ``range_hashes`` are polynomials modulo 2**64 over prefix sums: they cost the same for any
range of bytes, but texts made for it can share one, so they only make features of classifiers.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.session import scratch_path, ship

#: Bytes of text handled at once inside a task (one longer document is handled alone).
SLICE_BYTES = 1 << 21

_SEED = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_LENGTH, _STEP, _FIRST = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_ALL = np.uint64(2**64 - 1)
#: Longer words are hashed one by one.
LONG_WORD = 1024
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64 (kept for the next slice)."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, min(2 * n, SLICE_BYTES + 1))
        got = np.full(size, base, np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = got
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Slice:
    """Rows ``first .. last`` (exclusive) of a batch: their bytes, and where each row's begin."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of at most ``most`` bytes (one row at least).

    Null texts are empty. No bytes are copied.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first, n = 0, len(column)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Slice(first, last, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """The words of a slice: byte ranges, and ``bounds[i] .. bounds[i + 1]`` are row ``i``'s."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words(part: Slice) -> Words:
    """Locate the words of every row of a slice; a row's end always ends a word."""
    if not len(part.data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(part.rows + 1, np.int64))
    inside = ~_IS_SEPARATOR[part.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cuts = part.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, part.offsets))


def lowered(part: Slice) -> Slice:
    """The slice with A-Z in lower case (other letters stay)."""
    return Slice(part.first, part.last, _LOWER[part.data], part.offsets)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, mixed eight bytes at a time; equal bytes give equal hashes wherever they stand."""
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * _LENGTH + _FIRST)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    live = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
    done = 0
    while len(live):
        left = np.minimum(sizes[live] - done, 8).astype(np.uint64)
        lane = lanes[starts[live] + done] & (_ALL >> (np.uint64(64) - np.uint64(8) * left))
        out[live] = mix((out[live] ^ lane) * _STEP + _FIRST)
        done += 8
        live = live[sizes[live] > done]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of all byte prefixes, for ``range_hashes``."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    terms = _BYTE[data]
    terms *= powers(_BASE, len(data))
    np.cumsum(terms, out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges; equal bytes give equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(sums))[starts])


def word_hashes(part: Slice) -> tuple[Words, np.ndarray]:
    found = words(part)
    return found, byte_hashes(part.data, found.starts, found.ends)


def word_features(part: Slice) -> tuple[Words, np.ndarray]:
    """Words and their ``range_hashes``, as features of classifiers."""
    found = words(part)
    return found, range_hashes(prefix_sums(part.data), found.starts, found.ends)


def sequence_hashes(values: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``n`` consecutive 64-bit values (none when there are fewer)."""
    keys = np.random.Generator(np.random.PCG64(seed + 977)).integers(1, 2**63, 2 * n, dtype=np.uint64)
    size = len(values) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total += mix(values[i:i + size] ^ keys[2 * i]) * (keys[2 * i + 1] | np.uint64(1))
    return mix(total)


def rolling_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Like ``sequence_hashes`` for windows of some dozen values, at a cost that does not grow with ``n`` (a polynomial
    modulo 2**64: patterns that share a value take windows of about a thousand)."""
    size = len(values) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(mix(values) * powers(_BASE, len(values)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(_BASE_INVERSE, size))


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), with built-in functions."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(blank, " "), lambda w: w != "")).cast("long")


def split_share(doc_id: Column, modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo ``modulus``: names the held-out fold (null id: '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run's stage tables below the cluster's shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's table to the shared folder and read it again: later stages don't run its
    plan a second time, and a lost executor only costs its tasks."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows and bytes of an Arrow batch at most: the JVM and the worker of each task hold a batch several times.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2000, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 24}


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` of a function of this package, in batches of at most ``BATCH``; a worker that is kept for further
    tasks gives back what it no longer uses."""
    ship(df.sparkSession)
    for name, most in BATCH.items():
        df.sparkSession.conf.set(name, str(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from every column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
