"""Token files coded by a static range asymmetric numeral system (rANS).

A file holds segments of about ``SEGMENT`` ids in document order. A segment has one frequency
table that all its blocks share, and a directory. Blocks of up to ``BLOCK`` ids are coded
independently with ``LANES`` interleaved states each, so numpy codes all blocks and lanes of a segment at
once and any block can be decoded alone: its directory entry is a checkpoint (where its words begin,
and the lanes' states there) and the CRC-32 of its ids.

Segment layout, little-endian: the header (``_HEAD``: magic, documents, ids, symbols, scale bits,
lanes, steps, blocks, bytes of the packed tables), the tables packed with zlib (doc ids with null flags, ids per
document, symbols, their frequencies, first word and CRC-32 of each block), the states (uint64,
block by block), and the words (uint32). Id ``i`` of a block is step ``i // lanes`` of lane ``i % lanes``;
states lie in [2**31, 2**63) and give or take one 32-bit word at a time.

Scale: documents are range-partitioned by doc_id and streamed; a task holds one segment. Segments
are rows of a Parquet dataset (Spark commits or repeats whole tasks), numbered by task and place,
so reading is parallel by segment and a document's start is a running sum of segment sizes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pullscope.llm import text as T
from pullscope.llm.tokenise import encoder

SEGMENT = 1 << 20
BLOCK = 1 << 16
LANES = 64
#: Bytes of text encoded at once.
SLICE = 1 << 19
SCALE = 18
END = 2
TOKENIZER = "word_bpe_49k.json"

_MAGIC = b"RNS1"
_HEAD = struct.Struct("<4sIQIBIIIQ")
_LOW = np.uint64(1 << 31)


def frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to sum to 2**scale, at least 1 each."""
    total = int(counts.sum())
    exact = counts * ((1 << scale) / total)
    freq = np.maximum(np.floor(exact).astype(np.int64), 1)
    off = (1 << scale) - int(freq.sum())
    if off > 0:
        by = np.argsort(freq - exact, kind="stable")
        freq[by[np.arange(off) % len(by)]] += 1 if off <= len(by) else 0
        freq[int(np.argmax(freq))] += (1 << scale) - int(freq.sum())
    while off < 0:  # many rare symbols: take from the frequent ones
        give = np.minimum(freq - 1, np.maximum(freq * -off // max(int(freq[freq > 1].sum()), 1), 1))
        by = np.argsort(-freq, kind="stable")
        got = np.cumsum(give[by])
        give[by] = np.where(got <= -off, give[by], np.maximum(give[by] - (got + off), 0))
        freq -= give
        off = (1 << scale) - int(freq.sum())
    return freq


def pack(ids: np.ndarray, lengths: np.ndarray, doc_ids: list, block: int = BLOCK, lanes: int = LANES) -> bytes:
    """One segment: ``ids`` of documents of the given lengths."""
    n = len(ids)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    index = np.zeros(int(symbols[-1]) + 1 if n else 1, np.int32)
    index[symbols] = np.arange(len(symbols))
    scale = SCALE
    blocks = max(1, -(-n // block))
    steps = max(1, -(-n // (blocks * lanes)))
    padded = np.full(blocks * steps * lanes, int(np.argmax(counts)) if n else 0, np.int32)
    padded[:n] = index[ids]
    grid = padded.reshape(blocks, steps, lanes)
    freq = frequencies(counts) if n else np.array([1 << scale])
    if not n:
        symbols = np.zeros(1, np.int64)
    f = freq.astype(np.uint64)
    c = (np.cumsum(freq) - freq).astype(np.uint64)
    x = np.full((blocks, lanes), _LOW)
    gone = np.zeros((blocks, steps, lanes), bool)
    words = np.zeros((blocks, steps, lanes), np.uint32)
    top = np.uint64(63 - scale)
    for t in range(steps - 1, -1, -1):
        s = grid[:, t]
        fs = f[s]
        full = x >= (fs << top)
        gone[:, t] = full
        words[:, t] = x.astype(np.uint32)
        x = np.where(full, x >> np.uint64(32), x)
        q = x // fs
        x = (q << np.uint64(scale)) + (x - q * fs) + c[s]
    per_block = gone.reshape(blocks, -1).sum(axis=1)
    firsts = np.cumsum(per_block) - per_block
    stream = words[gone]
    wide = ids.astype("<u4")
    cuts = np.minimum(np.arange(blocks + 1) * (steps * lanes), n)
    crcs = [zlib.crc32(wide[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d if d is not None else 0 for d in doc_ids], "<i8")
    tables = zlib.compress(b"".join([known.tobytes(), numbers.tobytes(), lengths.astype("<u8").tobytes(),
                                     symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(),
                                     firsts.astype("<u8").tobytes(), np.array(crcs, "<u4").tobytes()]), 6)
    head = _HEAD.pack(_MAGIC, len(doc_ids), n, len(symbols), scale, lanes, steps, blocks, len(tables))
    return b"".join([head, tables, x.astype("<u8").tobytes(), stream.astype("<u4").tobytes()])


class Segment:
    """A packed segment: its directory is read at once, its blocks when asked for."""

    def __init__(self, raw: bytes):
        magic, docs, self.n, symbols, self.scale, self.lanes, self.steps, self.blocks, size = _HEAD.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at, tables = _HEAD.size, zlib.decompress(raw[_HEAD.size:_HEAD.size + size])
        pos = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal pos
            out = np.frombuffer(tables, kind, count, pos)
            pos += out.nbytes
            return out

        known, numbers, self.lengths = take("u1", docs), take("<i8", docs), take("<u8", docs).astype(np.int64)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, numbers)]
        self.symbols, freq = take("<u4", symbols), take("<u4", symbols)
        self.firsts, self.crcs = take("<u8", self.blocks).astype(np.int64), take("<u4", self.blocks)
        at += size
        self.states = np.frombuffer(raw, "<u8", self.blocks * self.lanes, at).reshape(self.blocks, self.lanes)
        at += self.states.nbytes
        self.words = np.frombuffer(raw, "<u4", (len(raw) - at) // 4, at)
        self.freq, self.start = freq.astype(np.uint64), (np.cumsum(freq, dtype=np.int64) - freq).astype(np.uint64)
        self.slots = np.repeat(np.arange(symbols, dtype=np.int32), freq)

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids of blocks ``first .. last`` (exclusive), each checked against its CRC-32."""
        last = self.blocks if last is None else last
        x = self.states[first:last].copy()
        at = self.firsts[first:last].copy()
        out = np.empty((last - first, self.steps, self.lanes), np.int32)
        mask, scale = np.uint64((1 << self.scale) - 1), np.uint64(self.scale)
        words = self.words if len(self.words) else np.zeros(1, "<u4")
        for t in range(self.steps):
            slot = x & mask
            s = self.slots[slot.astype(np.int64)]
            out[:, t] = s
            x = self.freq[s] * (x >> scale) + slot - self.start[s]
            low = x < _LOW
            rank = np.cumsum(low, axis=1)
            more = words[np.minimum(at[:, None] + rank - 1, len(words) - 1)].astype(np.uint64)
            x = np.where(low, (x << np.uint64(32)) | more, x)
            at += rank[:, -1]
        if (x != _LOW).any():  # every lane must end where its encoder began
            raise ValueError("a block of a token segment does not end in its first state")
        size = self.steps * self.lanes
        flat = self.symbols[out.reshape(-1)][:max(0, min(last * size, self.n) - first * size)]
        for b in range(first, last):
            own = flat[(b - first) * size:(b - first + 1) * size]
            if zlib.crc32(own.astype("<u4")) != int(self.crcs[b]):
                raise ValueError(f"block {b} of a token segment fails its checksum")
        return flat


def default_tokenizer() -> str:
    """Path of the public vocabulary file on this machine (each worker asks for its own)."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _coded(tokenizer: str | None, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, number = encoder(tokenizer or default_tokenizer()), TaskContext.get().partitionId(), 0
        ids, lengths, names, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            raw = pack(flat, np.concatenate(lengths), names)
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int64()), pa.array([number], pa.int64()), pa.array([len(flat)], pa.int64()),
                 pa.array([raw], pa.binary())], names=["task", "number", "ids", "segment"])

        for batch in batches:
            for part in T.slices(batch.column("text"), SLICE):
                flat, per_row = coder.ids(part, END)
                ids.append(flat)
                lengths.append(per_row)
                names += batch.column("doc_id")[part.first:part.last].to_pylist()
                size += len(flat)
                if size >= segment:
                    yield closed()
                    ids, lengths, names, size, number = [], [], [], 0, number + 1
        if names:
            yield closed()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, segment: int = SEGMENT) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into a token dataset at ``path``.

    ``tokenizer`` is a tokenizers-library file that every worker can read (default: the installed
    public one). Null texts are empty; every document ends with id 2. Null ids come first, rows with one id stand
    together in any order.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_mark"),
                        F.monotonically_increasing_id().alias("_at"))
    order = ["doc_id", "_mark", "_at"]  # rows with one id, or none, are dealt to several tasks
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    T.mapped(ordered, _coded(tokenizer, segment), "task long, number long, ids long, segment binary").write.parquet(path)


def _decoded(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task, number, raw in zip(batch.column("task"), batch.column("number"), batch.column("segment")):
                seg = Segment(raw.as_py())
                flat = seg.ids().astype("<u4")
                ends = np.cumsum(seg.lengths)
                starts = ends - seg.lengths
                n = len(seg.doc_ids)
                cols = [pa.array([task.as_py()] * n, pa.int64()), pa.array([number.as_py()] * n, pa.int64()),
                        pa.array(seg.doc_ids, pa.int64()), pa.array(starts), pa.array(seg.lengths),
                        pa.array([zlib.crc32(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())]
                names = ["task", "number", "doc_id", "inner", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                                         pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decode a token dataset, segment by segment in parallel. Per document: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32, and ids when asked for. A block that fails its
    checksum raises an error. An empty dataset gives an empty table."""
    files = spark.read.schema("task long, number long, ids long, segment binary").parquet(path)
    sizes = files.select("task", "number", "ids")
    per_task = sizes.groupBy("task").agg(F.sum("ids").alias("n"))
    # one row per task of the writer
    per_task = per_task.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    inner = (F.sum("ids").over(Window.partitionBy("task").orderBy("number")) - F.col("ids")).alias("within")
    base = (sizes.select("task", "number", inner).join(per_task, "task")
            .select("task", "number", (F.col("before") + F.col("within")).alias("base")))
    schema = "task long, number long, doc_id long, inner long, n_tokens long, ids_crc32 long"
    got = T.mapped(files.select("task", "number", "segment"), _decoded(with_ids), schema + (", ids array<int>" if with_ids else ""))
    out = got.join(base, ["task", "number"])
    return out.select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32",
                      *(["ids"] if with_ids else []))


def token_table(docs: DataFrame, tokenizer: str | None = None, path: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """Write ``docs`` as a token dataset (in the shared folder unless ``path`` is given) and describe
    every document from the files."""
    path = path or f"{T.new_folder(docs.sparkSession, 'tokens')}/ids"
    write_tokens(docs, path, tokenizer, segment)
    return read_tokens(docs.sparkSession, path)
