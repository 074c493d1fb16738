"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Each text is described by about twenty numbers (shares of character classes, lengths, repeated
words and lines, function words), each cut into quantile bins. Preference pairs put a document
labelled good above one labelled bad; logistic loss on the difference of their features gives a
weight per bin, and a document's score is the sum of its weights. The threshold is a quantile of
the training scores: the share of bad documents among the labelled rows. The published score is the logistic
curve that equals ``THRESHOLD`` at that quantile.

Every labelled row that may be learned from counts, in the bins, the pairs and the threshold. Rows are dealt to groups
of about ``GROUP_ROWS``; the pairs are all those of a good and a bad row of one group. Tasks sum the
gradient and curvature of their groups, the driver makes Newton steps on the sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm import text as T
from pullscope.llm.labelled import marked, one_per_id
from pullscope.llm.toxicity import FUNCTION_WORDS

#: Rows of a group of pairs, and rows of each class that it has on average at least (rows of a rare class are in several groups).
GROUP_ROWS = 1024
LEAST_ROWS = 32
#: Bins per feature, points of each class's distribution that their edges come from, Newton steps at most.
BINS = 10
POINTS = 1000
STEPS = 12
PENALTY = 1e-3
#: Scores are rounded to this many digits, so that the threshold's place among all of them can be counted.
DIGITS = 6
THRESHOLD = 0.3

FEATURES = ("log_words", "log_chars", "upper", "symbols", "shouts", "digits", "stops", "bars", "high_bytes", "word_bytes",
            "long_words", "ends_symbol", "distinct_words", "repeats_last", "lines_log", "lines_twice", "words_per_line",
            "function_words", "triples_twice", "sentences")


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.int8)
    table[[ord(c) for c in chars]] = 1
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_SYMBOL = _class("#$%&*~^<>{}[]=+@\\/_`")
_SHOUT, _DIGIT, _STOP, _BAR = _class("!?"), _class("0123456789"), _class(".,;:"), _class("|")
_HIGH = np.zeros(256, np.int8)
_HIGH[128:] = 1


def _function_hashes() -> np.ndarray:
    column = pa.array(sorted(set(" ".join(FUNCTION_WORDS.values()).split())))
    return np.sort(np.concatenate([T.word_features(p)[1] for p in T.slices(column)]))


def _share_twice(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how many there are in all (both per row)."""
    total = np.bincount(row, minlength=rows)
    by = np.argsort(T.mix(values + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    v, r = values[by], row[by]
    new = np.concatenate(([True], (v[1:] != v[:-1]) | (r[1:] != r[:-1]))) if len(v) else np.zeros(0, bool)
    return np.bincount(r[new], minlength=rows), total


def describe(part: T.Slice) -> np.ndarray:
    """``FEATURES`` of each row of a slice."""
    n = part.rows
    found, hashes = T.word_features(T.lowered(part))
    counts = found.counts
    size = np.diff(part.offsets)
    row = np.repeat(np.arange(n), counts)

    def summed(table: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[part.data], dtype=np.int64)))
        return sums[part.offsets[1:]] - sums[part.offsets[:-1]]

    per_byte, per_word = np.maximum(size, 1), np.maximum(counts, 1)
    lengths = found.ends - found.starts
    last = part.data[found.ends - 1] if len(lengths) else np.zeros(0, np.uint8)
    odd_end = (_SYMBOL | _SHOUT)[last]
    function = np.isin(hashes, _function_hashes())
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    distinct, _ = _share_twice(hashes, row, n)
    triple = T.sequence_hashes(hashes, 3)
    triple_row = row[:len(triple)]
    inside = triple_row == row[2:] if len(triple) else np.zeros(0, bool)
    triples, all_triples = _share_twice(triple[inside], triple_row[inside], n)
    # lines: byte ranges between line feeds
    feed = np.flatnonzero(part.data == 0x0A)
    cuts = np.unique(np.concatenate((part.offsets, feed + 1)))
    starts, ends = cuts[:-1], cuts[1:]
    ends = np.where((ends > starts) & (part.data[ends - 1] == 0x0A), ends - 1, ends) if len(starts) else ends
    full = ends > starts
    starts, ends = starts[full], ends[full]
    line_row = np.searchsorted(part.offsets, starts, "right") - 1
    sums = T.prefix_sums(part.data)
    lines, all_lines = _share_twice(T.range_hashes(sums, starts, ends), line_row, n)

    def by_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(row, flags, minlength=n) / per_word

    out = [np.log1p(counts), np.log1p(size), summed(_UPPER) / np.maximum(summed(_LETTER), 1), summed(_SYMBOL) / per_byte,
           summed(_SHOUT) / per_byte, summed(_DIGIT) / per_byte, summed(_STOP) / per_byte, summed(_BAR) / per_byte,
           summed(_HIGH) / per_byte, by_word(lengths), by_word(lengths >= 16), by_word(odd_end), distinct / per_word,
           by_word(again), np.log1p(all_lines), 1 - lines / np.maximum(all_lines, 1), counts / np.maximum(all_lines, 1),
           by_word(function), 1 - triples / np.maximum(all_triples, 1), by_word(_STOP[last])]
    return np.stack(out, axis=1)


@dataclass
class Model:
    edges: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for k in range(x.shape[1]):
            total += self.weights[k][np.searchsorted(self.edges[k], x[:, k], "right")]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.round(self.raw(x), DIGITS) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [describe(part) for part in T.slices(batch.column("text"))]
        x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("hash"), *[pa.array(x[:, k]) for k in range(len(FEATURES))]],
                                         names=["doc_id", "hash", *FEATURES])


def _matrix(batch) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy() for f in FEATURES], axis=1)


def _edges(rows: DataFrame) -> np.ndarray:
    """Edges of the bins: quantiles of each feature over all rows, both classes weighing the same."""
    shares = [(k + .5) / POINTS for k in range(POINTS)]
    points = rows.groupBy("label").agg(*[F.percentile_approx(f, shares, 10 * POINTS).alias(f) for f in FEATURES]).collect()
    both = np.stack([np.concatenate([r[f] for r in points]) for f in FEATURES])
    return np.quantile(both, np.arange(1, BINS) / BINS, axis=1).T


def _dealt(sent, groups: int, copies: dict[int, int], seed: int):
    """Bins of each row, once for each group that it is in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = sent.value
        for batch in batches:
            x, ids, y = _matrix(batch), batch.column("_id").to_numpy(), batch.column("label").to_numpy()
            bins = np.stack([np.searchsorted(edges[k], x[:, k], "right") for k in range(x.shape[1])], axis=1).astype(np.uint8)
            first = T.mix(ids.view(np.uint64) + np.uint64(seed)) % np.uint64(groups)
            times = np.where(y == 1, copies[1], copies[0])
            row = np.repeat(np.arange(len(y)), times)
            again = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            group = (first[row].astype(np.int64) + again) % groups
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(ids[row]), pa.array(y[row]), pa.array([b.tobytes() for b in bins[row]], pa.binary())],
                                             names=["grp", "_id", "label", "bins"])

    return run


def _gathered(table: pa.Table) -> pa.Table:
    """One row of a group's rows: the bins of the good ones and of the bad ones."""
    by = np.argsort(table.column("_id").to_numpy(), kind="stable")
    y, bins = table.column("label").to_numpy()[by], table.column("bins").to_pylist()
    good, bad = (b"".join(bins[i] for i, one in zip(by, y) if one == k) for k in (1, 0))
    return pa.table({"good": pa.array([good], pa.binary()), "bad": pa.array([bad], pa.binary())})


def _hot(bins: bytes) -> np.ndarray:
    at = np.frombuffer(bins, np.uint8).reshape(-1, len(FEATURES)).astype(np.int64)
    hot = np.zeros((len(at), len(FEATURES) * BINS))
    hot[np.arange(len(at))[:, None], at + np.arange(len(FEATURES)) * BINS] = 1
    return hot


def _summed(sent):
    """Gradient and curvature of the pairs' logistic loss, and the number of pairs, over a task's groups; by rows of the matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, pairs = sent.value, 0
        first, second = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for batch in batches:
            for one, other in zip(batch.column("good"), batch.column("bad")):
                good, bad = _hot(one.as_py()), _hot(other.as_py())
                wrong = 1 / (1 + np.exp(np.clip((good @ w)[:, None] - (bad @ w)[None, :], -60, 60)))
                bend = wrong * (1 - wrong)
                first += wrong.sum(axis=0) @ bad - wrong.sum(axis=1) @ good
                cross = good.T @ (bend @ bad)
                second += good.T @ (good * bend.sum(axis=1)[:, None]) + bad.T @ (bad * bend.sum(axis=0)[:, None]) - cross - cross.T
                pairs += wrong.size
        rows = [*second, first, np.full(1, float(pairs))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows))), pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))],
                                         names=["at", "sums"])

    return run


def _added(table: pa.Table) -> pa.Table:
    rows = sorted(table.column("sums").to_pylist())  # a sum must not depend on the order of its parts
    return pa.table({"at": table.column("at")[:1], "sums": pa.array([np.sum(rows, axis=0).tolist()], pa.list_(pa.float64()))})


def _weights(groups: DataFrame) -> np.ndarray:
    """Weights of the bins that make the mean logistic loss of all pairs and the penalty least, by Newton steps."""
    spark, n = groups.sparkSession, len(FEATURES) * BINS
    w = np.zeros(n)
    for _ in range(STEPS):
        parts = T.mapped(groups, _summed(spark.sparkContext.broadcast(w)), "at long, sums array<double>")
        got = dict(parts.groupBy("at").applyInArrow(_added, "at long, sums array<double>").collect())
        pairs = max(1.0, got[n + 1][0])
        first = np.array(got[n]) / pairs + PENALTY * w
        second = np.array([got[k] for k in range(n)]) / pairs + PENALTY * np.eye(n)
        step = np.linalg.solve(second, first)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _raw(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.round(model.raw(_matrix(batch)), DIGITS))], names=["raw"])

    return run


def _at_place(raw: DataFrame, place: int) -> float:
    """The value of the rows in ascending order at ``place`` (from 0), by counts: first of wide ranges, then within one."""
    wide = F.floor(F.col("raw") * 64)
    for value in (wide, F.col("raw")):
        counts = sorted(raw.groupBy(value.alias("v")).agg(F.count("*").alias("n")).collect())
        upto = np.cumsum([r["n"] for r in counts])
        k = int(np.searchsorted(upto, place, "right"))
        place -= int(upto[k] - counts[k]["n"])
        raw = raw.where(wide == counts[k]["v"])
    return float(counts[k]["v"])


def train(described: DataFrame, labels: DataFrame, learn) -> Model | None:
    """Fit on all rows of ``labels.quality`` over the ids that ``learn`` admits. ``described`` has doc_id, the text's hash
    and ``FEATURES`` of every row; sums over all learning rows reach the driver, no row does. None when a class is missing."""
    spark = described.sparkSession
    found, _ = marked(labels, "quality", learn)
    rows = one_per_id(described.withColumnRenamed("doc_id", "_id").join(found, "_id"), "hash", *FEATURES)
    folder = T.new_folder(spark, "quality")
    rows = T.stored(rows, f"{folder}/learned")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    total = sum(sizes.values())
    groups = max(1, total // GROUP_ROWS)
    copies = {k: min(groups, -(-LEAST_ROWS * groups // n)) for k, n in sizes.items()}
    edges = _edges(rows)
    dealt = T.mapped(rows, _dealt(spark.sparkContext.broadcast(edges), groups, copies, 8), "grp long, _id long, label int, bins binary")
    gathered = T.stored(dealt.groupBy("grp").applyInArrow(_gathered, "good binary, bad binary"), f"{folder}/groups")
    model = Model(edges, _weights(gathered).reshape(len(FEATURES), BINS), 0.0)
    raw = T.stored(T.mapped(rows, _raw(spark.sparkContext.broadcast(model)), "raw double"), f"{folder}/raw")
    below, above = (_at_place(raw, k) for k in (sizes[0] - 1, sizes[0]))
    model.cut = (below + above) / 2
    return model


def _scored(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = sent.value
        for batch in batches:
            score = model.scores(_matrix(batch)) if model else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)],
                                             names=["doc_id", "held_out", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted (1 where score >= ``THRESHOLD``).

    Learns from labelled rows outside the held-out fold. Null texts count as empty and get the score of
    an empty text; with no labels of either class every score is 0. Repeated rows and null ids are
    rows like others; columns other than doc_id and text are ignored.
    """
    fold = T.split_share(F.col("doc_id"), folds)
    spark, features = docs.sparkSession, ", ".join(f"{f} double" for f in FEATURES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    described = T.stored(T.mapped(rows, _described, f"doc_id long, hash long, {features}"), T.new_folder(spark, "described"))
    sent = spark.sparkContext.broadcast(train(described, labels, fold != held_out))
    out = T.mapped(described.withColumn("held_out", fold == held_out), _scored(sent), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
