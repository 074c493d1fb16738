"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is case-folded; runs of characters that are not letters become one space, and every 1-,
2- and 3-gram of the rest is hashed into ``BUCKETS`` counts. Training sums the counts of a
bounded sample of rows by language in Spark; the model is one matrix of log-probabilities (one
row per language) that is broadcast. A text's language maximises the prior plus the sum of its
n-grams' log-probabilities, computed for a slice of rows at a time as sums over the gathered
columns of its n-grams. Texts without a letter are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.text import mapped, slices, split_share

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
#: Training rows per language, about (whole texts are read, in training as in scoring).
SAMPLE_ROWS = 4000
#: Texts handled at once inside a task, in bytes of UTF-8.
SLICE = 1 << 19


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, with one space (0) around each run of letters;
    the text each stands in; and the number of letters of each text."""
    joined = "\x00".join(["", *[(t or "").casefold().replace("\x00", " ") for t in texts], ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.cumsum(points == 0) - 1
    is_letter = _letter_table()[np.minimum(points, 0x10FFFF)]
    counts = np.bincount(row[is_letter], minlength=len(texts) + 1)[:len(texts)]
    # keep letters and the first other character of each run, as a space
    keep = is_letter | np.concatenate(([True], is_letter[:-1])) | (points == 0)
    points = np.where(is_letter, points, 0)[keep]
    return points, row[keep], counts


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        table = np.zeros(0x110000, bool)
        for p in range(0x30000 + 0x3000):
            table[p] = chr(p).isalpha()
        _LETTERS.append(table)
    return _LETTERS[0]


def grams(points: np.ndarray, row: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram that lies within one text and holds a letter."""
    p = points.astype(np.uint64)
    for n in GRAMS:
        size = len(p) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, np.uint64)
        some = np.zeros(size, bool)
        for i in range(n):
            h = (h ^ p[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            some |= points[i:i + size] > 0
        ok = some & (row[:size] == row[n - 1:])
        yield row[:size][ok], (h[ok] % np.uint64(buckets)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages, float32

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log-posterior (up to a constant) of each text and language, and letters per text."""
        points, row, counts = letters(texts)
        total = np.tile(self.log_prior, (len(texts), 1))
        for at, bucket in grams(points, row):
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(at, self.log_prob[bucket, k], minlength=len(texts))[:len(texts)]
        return total, counts

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Best language of each text and its posterior probability; ``und`` and 0 without letters."""
        total, counts = self.scores(texts)
        if not self.languages:
            return np.array(["und"] * len(texts), object), np.zeros(len(texts))
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        none = counts == 0
        return (np.where(none, "und", np.array(self.languages, object)[best]), np.where(none, 0.0, share))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse n-gram counts by language of a task's rows."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        column, langs = batch.column("text"), batch.column("lang").to_pylist()
        for part in slices(column, SLICE):
            texts, own = column[part.first:part.last].to_pylist(), langs[part.first:part.last]
            for lang in sorted(set(own)):
                have = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                points, row, _ = letters([t for t, l in zip(texts, own) if l == lang])
                for _, bucket in grams(points, row):
                    have += np.bincount(bucket, minlength=BUCKETS)
    for lang, have in sums.items():
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(have[at])],
                                         names=["lang", "bucket", "n"])


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``text`` and ``lang``: about ``sample_rows`` rows per language, chosen by the hash of
    their doc_id and text, so that equal texts are chosen one by one (all where there are fewer). The matrix has ``BUCKETS`` rows and a column per
    language; that is what reaches the driver. Null and blank texts and null languages teach nothing."""
    rows = rows.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    counts = {r["lang"]: r["rows"] for r in sizes.collect()}  # one row per language
    if not counts:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    limit = F.lit(0.0)
    for lang, n in counts.items():
        limit = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / n))).otherwise(limit)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < limit * (1 << 30))
    summed = mapped(chosen.select("text", "lang"), _counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    languages = sorted(counts)
    matrix = np.full((BUCKETS, len(languages)), SMOOTHING)
    got = summed.toPandas()
    matrix[got.bucket.to_numpy(), got.lang.map({l: i for i, l in enumerate(languages)}).to_numpy()] += got.n.to_numpy()
    prob = np.log(matrix) - np.log(matrix.sum(axis=0, keepdims=True))
    prior = np.log(np.array([counts[l] for l in languages], float) / sum(counts.values()))
    return Model(languages, prior, prob.astype(np.float32))


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            column = batch.column("text")
            langs, scores = [], []
            for part in slices(column, SLICE):
                lang, score = m.predict(column[part.first:part.last].to_pylist())
                langs += lang.tolist()
                scores.append(score)
            keep = [batch.column(i) for i in range(batch.num_columns) if batch.schema.field(i).name != "text"]
            names = [f.name for f in batch.schema if f.name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=[*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, held_out: int = 2, folds: int = 4, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per input row: doc_id, held_out, lang_pred, score (posterior probability of lang_pred).

    Learns from rows outside the held-out fold (crc32 of the doc_id modulo ``folds``) that have a
    language. Null and empty texts and texts without a letter are ``und`` with score 0; so is
    everything when nothing was learned. Repeated rows and null ids are rows like others; other
    columns are ignored.
    """
    fold = split_share(F.col("doc_id"), folds)
    model = train(docs.where(fold != held_out), sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold == held_out).alias("held_out"), "text")
    return mapped(rows, _predicted(sent), "doc_id long, held_out boolean, lang_pred string, score double")
