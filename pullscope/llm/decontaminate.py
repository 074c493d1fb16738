"""Benchmark decontamination by spaced-seed hashing.

Texts are case-folded and cut into words at ASCII blanks and punctuation. A fixed mask laid over
consecutive words hashes the words under its ones and ignores those under its zeros, so a
substituted word under a zero does not hide a match. Every place of every benchmark item and every place of
every document is hashed under every mask, and equal hashes are joined. Around each hit document and
item are laid over one another, word by word: the item leaks when some ``overlap`` words of it in a row
agree in all but ``substitutions`` places. The masks are chosen so that every such overlap is hit (tests
enumerate all placements).

Items shorter than ``overlap`` must occur whole: with one substituted word where they have ``TOLERANT`` words or more
(each half is a seed, and one of them is intact), else unchanged. Items of fewer than ``shortest`` words say
nothing about a leak and are not searched.

Scale: one pass over the documents, in which a Bloom filter of the benchmark's seeds (at most 16 MB, however large
the benchmark is) drops nearly all places before anything is shuffled. What passes, and the seeds, carry their hash and the
words around it (25 at most), so hits meet in a join on the hash, which AQE splits where it is hot, and are verified there; the
texts themselves are not moved and nothing of the benchmark but the filter reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm import text as T

OVERLAP = 13
SUBSTITUTIONS = 2
SHORTEST = 5
#: Least words of an item shorter than the overlap that may have one substituted word.
TOLERANT = 8
#: Under these masks (weight 6) every 13 words with at most 2 substitutions have a hit.
MASKS = ("11101011", "11001111")
#: Bits of the filter for each seed, and in all (the filter is 16 MB at most).
BITS_PER_SEED = 16
MOST_BITS = 27
_CHUNK = 16
_PROBES = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

_BREAK = np.ones(256, bool)
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def folded(column: pa.Array) -> pa.Array:
    return pa.array([(t or "").casefold() for t in column.to_pylist()], pa.large_string())


def fold_words(part: T.Slice) -> tuple[T.Words, np.ndarray]:
    """Words and their hashes, cut at ASCII characters that are neither letters nor digits."""
    blank = np.where(_BREAK[part.data], np.uint8(0x20), part.data)
    return T.word_hashes(T.Slice(part.first, part.last, blank, part.offsets))


def mask_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the cared words at every place where the mask fits."""
    cared = [i for i, c in enumerate(mask) if c == "1"]
    size = len(hashes) - len(mask) + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(size, len(mask) * 1_000_003 + int(mask, 2), np.uint64)
    for i in cared:
        total = (total ^ hashes[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return T.mix(total)


def short_masks(n: int, shortest: int = SHORTEST) -> list[tuple[int, str]]:
    """(place, mask) of the seeds of an item of ``n`` words that is shorter than the overlap."""
    if n < shortest:
        return []
    if n < TOLERANT:
        return [(0, "1" * n)]
    return [(0, "1" * (n // 2)), (n // 2, "1" * (n - n // 2))]


def _around(hashes: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: int) -> np.ndarray:
    """The words from ``reach`` before to ``reach`` after each place, 0 outside lo .. hi."""
    index = at[:, None] + np.arange(-reach, reach + 1)
    inside = (index >= lo[:, None]) & (index < hi[:, None])
    return np.where(inside, hashes[np.clip(index, 0, max(len(hashes) - 1, 0))], np.uint64(0)) if len(hashes) else np.zeros(index.shape, np.uint64)


def _seeds(masks: tuple[str, ...], overlap: int, substitutions: int, shortest: int):
    """The seeds of benchmark items: hash, mask, place in the item, words that must agree (of how many), words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in T.slices(folded(batch.column("text"))):
                found, hashes = fold_words(part)
                out: list[tuple] = []
                for row in range(part.rows):
                    lo, hi = int(found.bounds[row]), int(found.bounds[row + 1])
                    n = hi - lo
                    own = hashes[lo:hi]
                    use = [(p, m) for m in masks for p in range(n - len(m) + 1)] if n >= overlap else short_masks(n, shortest)
                    if not use:
                        continue
                    size = min(n, overlap)
                    need = size - (substitutions if n >= overlap else int(n >= TOLERANT))
                    by_mask = {m: mask_hashes(own, m) for m in dict.fromkeys(m for _, m in use)}
                    places = np.array([p for p, _ in use])
                    near = _around(own, places, np.zeros(len(use), np.int64), np.full(len(use), n), overlap - 1)
                    item = batch.column("item_id")[part.first + row].as_py()
                    out += [(int(by_mask[m][p].view(np.int64)), m, base + part.first + row, item, p, size, need, w.tobytes())
                            for (p, m), w in zip(use, near, strict=True)]
                if out:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                    names = ["hash", "mask", "item", "item_id", "place", "size", "need", "item_words"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            base += batch.num_rows

    return run


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in _PROBES:
        yield (hashes * k) >> np.uint64(64 - bits)


def _filter_chunks(bits: int):
    """The bits of a task's seeds, in pieces of the filter that hold any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << bits, bool)
        for batch in batches:
            for places in _probes(batch.column("hash").to_numpy().view(np.uint64), bits):
                held[places] = True
        pieces = held.reshape(-1, 1 << min(_CHUNK, bits))
        some = np.flatnonzero(pieces.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([np.packbits(pieces[i]).tobytes() for i in some], pa.binary())],
                                         names=["piece", "bits"])

    return run


def _united(table: pa.Table) -> pa.Table:
    got = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
    return pa.table({"piece": table["piece"][:1], "bits": pa.array([got.tobytes()], pa.binary())})


def _bloom(seeds: DataFrame, bits_per_seed: int) -> tuple[np.ndarray, int]:
    """(packed filter, its size as a power of two) of all seeds."""
    wanted = max(1, seeds.count() * bits_per_seed)
    bits = min(max(10, wanted.bit_length()), MOST_BITS)
    parts = T.mapped(seeds.select("hash"), _filter_chunks(bits), "piece long, bits binary")
    out = np.zeros((max(1, (1 << bits) >> _CHUNK), (1 << min(_CHUNK, bits)) // 8), np.uint8)
    for r in parts.groupBy("piece").applyInArrow(_united, "piece long, bits binary").collect():  # 16 MB at most
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1), bits


def _hits(masks: list[str], packed: np.ndarray, bits: int, reach: int):
    """Places of documents whose hash may be that of a seed, with the words around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in T.slices(folded(batch.column("text"))):
                found, hashes = fold_words(part)
                for mask in masks:
                    h = mask_hashes(hashes, mask)
                    at = np.arange(len(h))
                    for places in _probes(h, bits):  # each probe looks at what the ones before left
                        places = places[at]
                        at = at[(packed[places >> np.uint64(3)] >> (np.uint8(7) - (places & np.uint64(7)).astype(np.uint8))) & 1 > 0]
                    row = np.searchsorted(found.bounds, at, "right") - 1
                    inside = at + len(mask) <= found.bounds[row + 1]
                    at, row = at[inside], row[inside]
                    if not len(at):
                        continue
                    near = _around(hashes, at, found.bounds[row], found.bounds[row + 1], reach)
                    rows = pa.array(part.first + row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[at].view(np.int64)), pa.array([mask] * len(at)), pa.array(base + part.first + row),
                         batch.column("doc_id").cast(pa.int64()).take(rows), batch.column("mark").take(rows),
                         pa.array((at - found.bounds[row]).astype(np.int64)), pa.array([w.tobytes() for w in near], pa.binary())],
                        names=["hash", "mask", "rid", "doc_id", "text_mark", "pos", "doc_words"])
            base += batch.num_rows

    return run


def agreement(doc: np.ndarray, item: np.ndarray, size: int) -> np.ndarray:
    """Per row of two matrices of words laid over one another: most equal words among ``size`` in a row that both have
    (0 where they have no such stretch)."""
    both, same = (doc != 0) & (item != 0), doc == item
    zero = np.zeros((len(doc), 1), np.int64)
    sums = [np.hstack([zero, np.cumsum(x & both, axis=1)]) for x in (same, both)]
    equal, there = (x[:, size:] - x[:, :-size] for x in sums)
    return np.where(there == size, equal, 0).max(axis=1)


def _verified(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, item = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, 2 * reach + 1)
                         for c in ("doc_words", "item_words"))
            sizes, need = batch.column("size").to_numpy(), batch.column("need").to_numpy()
            got = np.zeros(len(doc), np.int64)
            for size in np.unique(sizes):
                on = sizes == size
                got[on] = agreement(doc[on], item[on], int(size))
            start = batch.column("pos").to_numpy() - batch.column("place").to_numpy()
            cols = [batch.column(c) for c in ("rid", "doc_id", "text_mark", "item", "item_id")]
            out = pa.RecordBatch.from_arrays([*cols, pa.array(got), pa.array(start.astype(np.int64))],
                                             names=["rid", "doc_id", "text_mark", "item", "item_id", "agreeing", "word_start"])
            yield out.filter(pa.array(got >= need))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, substitutions: int = SUBSTITUTIONS,
          shortest: int = SHORTEST, masks: tuple[str, ...] = MASKS, bits_per_seed: int = BITS_PER_SEED) -> DataFrame:
    """One row per input row and benchmark item that leaks into it: doc_id, mark (a hash of the
    text, which tells rows with one doc_id apart), item_id, agreeing (most equal words in an overlap) and
    word_start (where the item starts among the document's words; negative if it began before).

    Null and empty texts, and null benchmark texts, leak nothing. Repeated rows and repeated items give repeated
    results; an empty benchmark or table gives an empty result. Other columns are ignored.
    """
    folder = T.new_folder(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    seeds = T.stored(T.mapped(items, _seeds(masks, overlap, substitutions, shortest),
                              "hash long, mask string, item long, item_id long, place int, size int, need int, item_words binary"),
                     f"{folder}/seeds")
    used = sorted(r["mask"] for r in seeds.select("mask").distinct().collect())  # the given masks and runs of a few words
    packed, bits = _bloom(seeds, bits_per_seed)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    hits = T.stored(T.mapped(texts, _hits(used, packed, bits, overlap - 1),
                             "hash long, mask string, rid long, doc_id long, text_mark long, pos long, doc_words binary"), f"{folder}/hits")
    checked = T.mapped(hits.join(seeds, ["hash", "mask"]).drop("hash", "mask"), _verified(overlap - 1),
                       "rid long, doc_id long, text_mark long, item long, item_id long, agreeing long, word_start long")
    best = F.max(F.struct("agreeing", (-F.col("word_start")).alias("before"))).alias("best")
    found = checked.groupBy("rid", "item").agg(F.first("doc_id").alias("doc_id"), F.first("text_mark").alias("mark"),
                                               F.first("item_id").alias("item_id"), best)
    return found.select("doc_id", "mark", "item_id", F.col("best.agreeing").alias("agreeing"), (-F.col("best.before")).alias("word_start"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a leaked benchmark item, columns unchanged."""
    one, two = T.fresh(docs, "id", "mark")
    bad = T.stored(leaks(docs, benchmark, **options).select(F.col("doc_id").alias(one), F.col("mark").alias(two)).distinct(),
                   T.new_folder(docs.sparkSession, "leaks"))
    same = docs["doc_id"].cast("long").eqNullSafe(bad[one]) & (F.xxhash64(docs["text"]) == bad[two])
    return docs.join(bad, same, "left_anti")
