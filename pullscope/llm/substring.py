"""Repeated-passage removal by suffix automata of reference shards.

A window is ``window`` consecutive words of one document. Every word covered by a window whose word
sequence also starts anywhere else is removed.

1. Equal word sequences (SHA-256) form classes; one document of each goes on. A document with a copy is
   covered whole if it has a window at all.
2. Candidates: each window is represented by the smallest hash among its ``ANCHOR``-word grams. Equal
   windows have equal anchors, and neighbouring windows mostly share one, so only about a tenth of
   all places is counted. The windows of one anchor that occurs twice form a piece; equal windows are in pieces of
   the same anchor.
3. Pieces are sorted by anchor and streamed past the suffix automaton of a reference shard. Matching statistics
   (the longest suffix read so far that occurs in the shard) of ``window`` or more mark the words of the piece, and
   the place where the automaton's state first occurred marks the words there. A piece with a window that did not match
   joins the reference. A shard ends between two anchors, when it has ``SHARD_WORDS`` words.

An automaton thus finds every repeat: a window that occurs once in its shard is the only one of its kind.

Scale: the reference grows with the corpus, so no automaton holds all of it; each task builds the shards of its
anchors, one at a time. An anchor with very many pieces is dealt to several tasks, each with a shard of its own; the
windows that such a shard met once go to a second round, dealt by the whole window, so no task holds a hot
anchor or all the texts that follow a common phrase. Counts are map-side aggregates; joins on hot hashes are inner joins that AQE
splits. Words travel as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm import text as T

WINDOW = 35
ANCHOR = 18
SHARD_WORDS = 20_000
#: Pieces of one anchor that a shard takes, about.
HOT_PIECES = 1000


def anchors(hashes: np.ndarray, lo: int, hi: int, grams: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """Anchor position of each window of the words lo .. hi (none when there are too few)."""
    n = hi - lo - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    span = window - anchor + 1
    view = np.lib.stride_tricks.sliding_window_view(grams[lo:hi - anchor + 1], span)
    return view.argmin(axis=1) + np.arange(n)


def _anchored(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in T.slices(batch.column("text")):
                found, hashes = T.word_hashes(part)
                grams = T.rolling_hashes(hashes, anchor)
                raw, starts, ends = part.data.tobytes(), found.starts.tolist(), found.ends.tolist()
                shas, where, at, keys = [], [0], [], []
                for lo, hi in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
                    shas.append(hashlib.sha256(b" ".join([raw[a:b] for a, b in zip(starts[lo:hi], ends[lo:hi])])).hexdigest())
                    own = np.unique(anchors(hashes, lo, hi, grams, window, anchor))
                    at.append(own)
                    keys.append(grams[lo + own])
                    where.append(where[-1] + len(own))
                offsets = pa.array(where, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + part.rows)), batch.column("doc_id")[part.first:part.last],
                    batch.column("mark")[part.first:part.last], pa.array(found.counts), pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(at).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64)))],
                    names=["rid", "doc_id", "mark", "n_words", "sha", "at", "key"])
                rid += part.rows

    return run


def _pieces(window: int, anchor: int):
    """The pieces of the wanted anchors of each document: key, place of the first word, and the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch.column("text")):
                found, hashes = T.word_hashes(part)
                grams = T.rolling_hashes(hashes, anchor)
                rids, keys, salts, starts, words = [], [], [], [], []
                for row in range(part.rows):
                    lo, hi = int(found.bounds[row]), int(found.bounds[row + 1])
                    wanted = batch.column("wanted")[part.first + row].values
                    at = np.asarray(wanted.field("at"))
                    of = anchors(hashes, lo, hi, grams, window, anchor)  # never falls from one window to the next
                    first, last = np.searchsorted(of, at, "left"), np.searchsorted(of, at, "right")
                    rids += [batch.column("rid")[part.first + row].as_py()] * len(at)
                    keys.append(np.asarray(wanted.field("key")))
                    salts.append(np.asarray(wanted.field("salts")))
                    starts.append(first)
                    words += [hashes[lo + a:lo + b + window - 1] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                if rids:
                    yield _piece_batch(rids, np.concatenate(keys), np.concatenate(salts), np.concatenate(starts), words)

    return run


def _piece_batch(rids: list, keys: np.ndarray, salts: np.ndarray, starts: np.ndarray, words: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int32)
    flat = np.concatenate(words).view(np.int64) if words else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(salts, pa.int32()), pa.array(rids, pa.int64()), pa.array(starts, pa.int32()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["key", "salts", "rid", "start", "words"])


class Automaton:
    """Suffix automaton of word sequences, kept apart by marks that no word equals. ``first`` is the place, in the
    sequences one after the other, where a state's words first ended."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [-1]
        self.last = 0
        self.size = 0

    def add(self, words: list[int]) -> int:
        """Append a sequence and return the place of its first word."""
        at = self.size
        for w in words:
            self._extend(w)
        self._extend(("end", self.size))
        return at

    def _extend(self, w) -> None:
        follow, link, length = self.next, self.link, self.length
        cur = len(follow)
        follow.append({})
        length.append(length[self.last] + 1)
        link.append(0)
        self.first.append(self.size)
        self.size += 1
        p = self.last
        while p >= 0 and w not in follow[p]:
            follow[p][w] = cur
            p = link[p]
        if p >= 0:
            q = follow[p][w]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                self.first.append(self.first[q])
                while p >= 0 and follow[p].get(w) == q:
                    follow[p][w] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        self.last = cur

    def matches(self, words: list[int], least: int) -> tuple[list[int], list[int]]:
        """Where a run of ``least`` or more words that occurs here ends: in ``words``, and here for the first time."""
        follow, link, length, first = self.next, self.link, self.length, self.first
        here, there = [], []
        state = size = 0
        for i, w in enumerate(words):
            to = follow[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = follow[state].get(w)
            if to is None:
                size = 0
                continue
            state = to
            size += 1
            if size >= least:
                here.append(i)
                there.append(first[state])
        return here, there


def covered(ends: list[int], window: int) -> Iterator[tuple[int, int]]:
    """Stretches covered by windows with these last places (ascending)."""
    lo = hi = None
    for e in ends:
        if hi is not None and e - window + 1 <= hi:
            hi = e + 1
        else:
            if hi is not None:
                yield lo, hi
            lo, hi = e - window + 1, e + 1
    if hi is not None:
        yield lo, hi


class Shard:
    """A reference shard: its automaton, whose pieces it holds, and the places where their windows were met again."""

    def __init__(self):
        self.automaton = Automaton()
        self.pieces: list[tuple[int, int, int]] = []  # place in the shard, rid, first word
        self.again: set[int] = set()

    def spans(self, window: int) -> Iterator[tuple[int, int, int]]:
        """(rid, lo, hi) of the reference's own words that were met again."""
        k = 0
        ends = sorted(self.again)
        for n, (at, rid, start) in enumerate(self.pieces):
            until = self.pieces[n + 1][0] if n + 1 < len(self.pieces) else self.automaton.size
            own = []
            while k < len(ends) and ends[k] < until:
                own.append(ends[k] - at)
                k += 1
            for lo, hi in covered(own, window):
                yield rid, start + lo, start + hi


def _matched(window: int, shard_words: int):
    """Stream pieces, sorted by key, past the shards that they build. Rows: spans to remove (rid, lo, hi), and for keys
    with several shards the windows that this one met first (rid, lo, key, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = Shard(), None
        for batch in batches:
            spans: list[tuple[int, int, int]] = []
            rids, starts, alone = [], [], []
            where, flat = batch.column("words").offsets.to_numpy(), batch.column("words").values.to_numpy()
            cols = [batch.column(c).to_pylist() for c in ("key", "salt", "salts", "rid", "start")]
            for i, (key, salt, salts, rid, start) in enumerate(zip(*cols, strict=True)):
                if (key, salt) != now:
                    if shard.automaton.size > shard_words:
                        spans += shard.spans(window)
                        shard = Shard()
                    now = key, salt
                own = flat[where[i]:where[i + 1]]
                words = own.tolist()
                here, there = shard.automaton.matches(words, window)
                spans += [(rid, start + lo, start + hi) for lo, hi in covered(here, window)]
                shard.again.update(there)
                if len(here) < len(words) - window + 1:
                    shard.pieces.append((shard.automaton.add(words), rid, start))
                    if salts > 1:
                        met = set(here)
                        for end in range(window - 1, len(words)):
                            if end not in met:
                                rids.append(rid)
                                starts.append(start + end - window + 1)
                                alone.append(own[end - window + 1:end + 1].view(np.uint64))
            yield _found(spans)
            if rids:
                keys = [int(T.rolling_hashes(w, window)[0].view(np.int64)) for w in alone]
                ones = _piece_batch(rids, np.array(keys), np.ones(len(keys)), np.array(starts), alone)
                none = pa.nulls(len(rids), pa.int32())
                yield pa.RecordBatch.from_arrays([ones.column("rid"), ones.column("start"), none, ones.column("key"), ones.column("words")],
                                                 names=["rid", "lo", "hi", "key", "words"])
        yield _found(list(shard.spans(window)))

    return run


def _found(spans: list[tuple[int, int, int]]) -> pa.RecordBatch:
    rids, los, his = zip(*spans, strict=True) if spans else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(rids, pa.int64()), pa.array(los, pa.int32()), pa.array(his, pa.int32()), pa.nulls(len(rids), pa.int64()),
         pa.nulls(len(rids), pa.list_(pa.int64()))], names=["rid", "lo", "hi", "key", "words"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words left of each document when its spans are gone."""
    for batch in batches:
        rids, gone, shas = [], [], []
        for part in T.slices(batch.column("text")):
            found = T.words(part)
            raw = part.data.tobytes()
            for row in range(part.rows):
                lo, hi = int(found.bounds[row]), int(found.bounds[row + 1])
                keep = np.ones(hi - lo, bool)
                for span in batch.column("spans")[part.first + row].as_py():
                    keep[span["lo"]:span["hi"]] = False
                at = (lo + np.flatnonzero(keep)).tolist()
                left = b" ".join([raw[found.starts[i]:found.ends[i]] for i in at])
                rids.append(batch.column("rid")[part.first + row].as_py())
                gone.append(int((~keep).sum()))
                shas.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(gone, pa.int64()), pa.array(shas, pa.string())],
                                         names=["rid", "n_removed", "kept_sha256"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS,
                   hot_pieces: int = HOT_PIECES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored frames: the rows (rid, doc_id, mark, n_words, sha, rep, copies; rep is the class's first
    row), the spans to remove of class heads without copies (rid, lo, hi in words) and their texts (rid, text).

    Null texts have no words. Repeated rows and null ids are rows like others.
    """
    spark = docs.sparkSession
    folder, n = T.new_folder(spark, "substring"), T.partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    rows = T.stored(T.mapped(docs, _anchored(window, anchor), "rid long, doc_id long, mark long, n_words long, sha string, "
                             "at array<int>, key array<long>"), f"{folder}/rows")
    classes = T.stored(rows.groupBy("sha").agg(F.min("rid").alias("rep"), F.count("*").alias("copies")), f"{folder}/classes")
    heads = rows.join(classes.select(F.col("rep").alias("rid")), "rid").select("rid", F.explode(F.arrays_zip("at", "key")).alias("a"))
    heads = T.stored(heads.select("rid", F.col("a.at").alias("at"), F.col("a.key").alias("key")), f"{folder}/anchors")
    # stored, so that the join below is between plain tables and AQE can split a hot anchor
    twice = T.stored(heads.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
                     .select("key", F.ceil(F.col("n") / hot_pieces).cast("int").alias("salts")), f"{folder}/twice")
    wanted = heads.join(twice, "key").groupBy("rid").agg(F.collect_list(F.struct("at", "key", "salts")).alias("wanted"))
    named = T.stored(wanted.join(rows.select("rid", "doc_id", "mark"), "rid")
                     .select("rid", "wanted", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")), f"{folder}/wanted")
    texts = T.stored(docs.join(named, docs["doc_id"].eqNullSafe(named["_id"]) & (docs["mark"] == named["_mark"]))
                     .select("rid", "wanted", "text").dropDuplicates(["rid"]), f"{folder}/texts")
    pieces = T.mapped(texts, _pieces(window, anchor), "key long, salts int, rid long, start int, words array<long>")
    dealt = (pieces.withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("salts")).cast("int"))
             .repartition(n, "key", "salt").sortWithinPartitions("key", "salt"))
    out = "rid long, lo int, hi int, key long, words array<long>"
    found = T.stored(T.mapped(dealt, _matched(window, shard_words), out), f"{folder}/found")
    # second round: windows that several shards of one anchor have met once each
    again = found.where("words is not null").select("key", F.lit(1).alias("salts"), "rid", F.col("lo").alias("start"), "words",
                                                    F.lit(0).alias("salt"))
    again = again.repartition(n, "key").sortWithinPartitions("key")
    more = T.stored(T.mapped(again, _matched(window, shard_words), out), f"{folder}/found-again")
    spans = found.where("hi is not null").union(more.where("hi is not null")).select("rid", "lo", "hi")
    return rows.drop("at", "key").join(classes, "sha"), spans, texts.select("rid", "text")


def substring_dedup(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space).

    Windows are judged on the input. Null and blank texts have no words; a document with fewer words than
    ``window`` loses none. Repeated rows are copies of one another. Other columns are ignored.
    """
    rows, spans, texts = repeated_spans(docs, window, **options)
    cut = (texts.join(spans.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "rid")
           .select("rid", "text", "spans"))
    cut = T.stored(T.mapped(cut, _without, "rid long, n_removed long, kept_sha256 string"),
                   T.new_folder(docs.sparkSession, "substring-cut"))
    copied = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return (rows.join(cut, "rid", "left")
            .select("doc_id", "n_words", F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))
