"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of three hashed rows: the word, its first four and its first six
bytes. Only rows whose features differ between the classes in training are kept; all other words
are the zero vector, so a word never seen leaves a score as it is. Filters of widths 1, 2 and 3
slide over the words, the largest activation of each filter over the whole text is kept, and a
logistic layer turns these into a logit.

Thresholds are calibrated by language on rows kept out of the gradient steps: each language gets
the logit that separates its classes best, and the score is the logistic curve that is 0.7 there.
The language is read off function words in the text; labels.lang is not used.

Every labelled row that may be learned from counts, for features, gradient steps and thresholds. Up to ``PART_ROWS`` rows are
fitted at once. More are dealt to parts of about that size: in each epoch every part makes its own steps from the same
parameters, and the parts' parameters are averaged. Thresholds then come from counts of all calibration rows by logit.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pullscope.llm import text as T
from pullscope.llm.decontaminate import _BREAK, folded
from pullscope.llm.labelled import marked, one_per_id

#: Rows that one task trains on, and bytes of their kept features (whole texts are read, in training as in scoring).
PART_ROWS = 5000
PART_BYTES = 1 << 25
#: Texts handled at once in training, in bytes, and feature counts that are added up before they are handed on.
SLICE = 1 << 18
COUNTS = 1 << 19
#: Rows of the embedding that are averaged at once.
BLOCK = 1 << 8
#: Calibration counts logits to this many digits, within these bounds.
DIGITS = 2
FARTHEST = 60
VOCABULARY = 1 << 14
LEAST_Z = 2.5
DIMENSIONS = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
EPOCHS = 6
#: Share of feature rows left out of each gradient step, and where between the last text below and the first
#: above it a cut lies.
DROPPED = 0.35
NEARER = 0.35
THRESHOLD = 0.7
SLOTS = 1 << 20

#: Function words by language (fixed values), for the choice of a threshold.
FUNCTION_WORDS = {
    "de": "der die das und den ist nicht von mit für",
    "en": "the of and to that is with for it was",
    "es": "el los las y del por con una se su",
    "fr": "le les des et est dans pour une qui du",
}


def hashed(part: T.Slice) -> tuple[T.Words, np.ndarray]:
    """Words, and three feature hashes of each: the word, its first 4 and its first 6 bytes."""
    blank = np.where(_BREAK[part.data], np.uint8(0x20), part.data)
    found = T.words(T.Slice(part.first, part.last, blank, part.offsets))
    sums = T.prefix_sums(blank)
    out = [T.range_hashes(sums, found.starts, found.ends)]
    for n, salt in ((4, 0x51ED270B), (6, 0x7F4A7C15)):
        ends = np.minimum(found.starts + n, found.ends)
        out.append(T.range_hashes(sums, found.starts, ends) ^ np.uint64(salt))
    return found, np.stack(out)


def _function_hashes() -> tuple[list[str], np.ndarray, np.ndarray]:
    names = sorted(FUNCTION_WORDS)
    keys, owner = [], []
    for k, name in enumerate(names):
        for part in T.slices(pa.array([FUNCTION_WORDS[name]])):
            h = hashed(part)[1][0]
            keys.append(h)
            owner.append(np.full(len(h), k))
    key = np.concatenate(keys)
    by = np.argsort(key)
    return names, key[by], np.concatenate(owner)[by]


def languages(found: T.Words, word_hashes: np.ndarray) -> np.ndarray:
    """Index of the language whose function words are most frequent in each text (-1: none)."""
    names, key, owner = _function_hashes()
    at = np.minimum(np.searchsorted(key, word_hashes), len(key) - 1)
    hit = np.flatnonzero(key[at] == word_hashes)
    row = np.searchsorted(found.bounds, hit, "right") - 1
    counts = np.zeros((len(found.bounds) - 1, len(names)), np.int64)
    np.add.at(counts, (row, owner[at[hit]]), 1)
    return np.where(counts.any(axis=1), counts.argmax(axis=1), -1)


@dataclass
class Model:
    keys: np.ndarray  # hashes of the kept features, strongest first; feature i has row i + 1 of ``embed``
    embed: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    cuts: np.ndarray
    default_cut: float

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("slot_")}

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding rows of feature hashes; 0 (the zero vector) for features that were not kept.

        The hash table is built where the model is used, so that only the keys are sent."""
        if not hasattr(self, "slot_row"):
            self.slot_check, self.slot_row = np.zeros(SLOTS, np.uint32), np.zeros(SLOTS, np.int32)
            at, order = (self.keys & np.uint64(SLOTS - 1)).astype(np.int64), np.arange(len(self.keys))[::-1]
            # of two features in one slot the stronger stays
            self.slot_check[at[order]], self.slot_row[at[order]] = (self.keys[order] >> np.uint64(32)).astype(np.uint32), order + 1
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        return np.where(self.slot_check[slot] == (hashes >> np.uint64(32)).astype(np.uint32), self.slot_row[slot], 0)

    def pooled(self, found: T.Words, rows: np.ndarray, arg: bool = False):
        """Largest activation of each filter over each text (positions too, for training).

        Only places near a kept feature are computed; all others equal the bias.
        """
        texts, n = len(found.bounds) - 1, rows.shape[1]
        active = rows.any(axis=0)
        row_of = np.repeat(np.arange(texts), found.counts)
        pools, places = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.bias):
            near = np.zeros(n + width, bool)
            for j in range(width):
                near[:n] |= np.concatenate((active[j:], np.zeros(min(j, n), bool)))
            p = np.flatnonzero(near[:n])
            act = np.tile(b, (len(p), 1))
            for j in range(width):
                q = np.minimum(p + j, max(n - 1, 0))
                inside = (p + j < n) & (row_of[q] == row_of[p]) if len(p) else np.zeros(0, bool)
                x = self.embed[rows[:, q]].sum(axis=0) * inside[:, None]
                act += x @ w[j * DIMENSIONS:(j + 1) * DIMENSIONS]
            best = np.tile(b, (texts, 1))
            where = np.full((texts, len(b)), -1)
            if len(p):
                owners, heads = np.unique(row_of[p], return_index=True)
                top = np.maximum.reduceat(act, heads, axis=0)
                if arg:
                    ends = np.append(heads[1:], len(p))
                    for o, a, z in zip(owners, heads, ends):
                        where[o] = p[a + act[a:z].argmax(axis=0)]
                wins = top > best[owners]
                best[owners] = np.where(wins, top, best[owners])
                where[owners] = np.where(wins, where[owners], -1)
            pools.append(best)
            places.append(where)
        pre = np.concatenate(pools, axis=1)
        return (pre, np.concatenate(places, axis=1)) if arg else pre

    def logits(self, found: T.Words, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(found, rows), 0) @ self.out + self.out_bias

    def scores(self, part: T.Slice) -> np.ndarray:
        """0 to 1; ``THRESHOLD`` at the calibrated cut of the text's language."""
        found, hashes = hashed(part)
        logit = self.logits(found, self.rows(hashes))
        lang = languages(found, hashes[0])
        cut = np.where(lang >= 0, self.cuts[lang], self.default_cut)
        z = np.round(logit - cut, 9) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _folded(column: pa.Array, most: int = T.SLICE_BYTES) -> Iterator[tuple[int, T.Slice]]:
    """Slices of the folded texts, each with the row of ``column`` that its row 0 counts from."""
    for rough in T.slices(column, most):
        for part in T.slices(folded(column[rough.first:rough.last]), most):
            yield rough.first, part


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a feature stands, added up over ``COUNTS`` features at least."""
    kept: list[tuple] = []

    def added() -> pa.RecordBatch:
        flat, m0, m1 = (np.concatenate(x) for x in zip(*kept))
        kept.clear()
        key, back = np.unique(flat, return_inverse=True)
        n0, n1 = (np.bincount(back, m, minlength=len(key)).astype(np.int64) for m in (m0, m1))
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n0), pa.array(n1)], names=["key", "n0", "n1"])

    for batch in batches:
        y = batch.column("label").to_numpy()
        for first, part in _folded(batch.column("text"), SLICE):
            found, hashes = hashed(part)
            bounds = found.bounds.tolist()
            once = [np.unique(hashes[:, lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
            flat, ones = np.concatenate(once), np.repeat(y[first + part.first:first + part.last], [len(x) for x in once])
            key, back = np.unique(flat, return_inverse=True)
            n1 = np.bincount(back, ones, minlength=len(key))
            kept.append((key, np.bincount(back, minlength=len(key)) - n1, n1))
            if sum(len(k[0]) for k in kept) >= COUNTS:
                yield added()
    if kept:
        yield added()


def _differing(all0: int, all1: int):
    """Features whose share of texts differs between classes of ``all0`` and ``all1`` texts, and by how much (z)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1 = batch.column("n0").to_numpy(), batch.column("n1").to_numpy()
            odds = np.log((n1 + .5) / (all1 - n1 + .5)) - np.log((n0 + .5) / (all0 - n0 + .5))
            z = odds / np.sqrt(1 / (n1 + .5) + 1 / (all1 - n1 + .5) + 1 / (n0 + .5) + 1 / (all0 - n0 + .5))
            z = np.round(z, 9)  # a z must not depend on the rows that share its batch
            pick = np.flatnonzero((np.abs(z) >= LEAST_Z) & (n0 + n1 >= 3))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(pick)), pa.array(z[pick])], names=["key", "z"])

    return run


def _features(sample: DataFrame, all0: int, all1: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features whose share of texts differs most between the classes, and by how much (z)."""
    summed = T.mapped(sample.select("label", "text"), _counted, "key long, n0 long, n1 long").groupBy("key").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    differing = T.mapped(summed, _differing(all0, all1), "key long, z double")
    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    got = differing.orderBy(F.abs("z").desc(), unsigned).limit(VOCABULARY).toPandas()
    key, z = got.key.to_numpy().view(np.uint64), got.z.to_numpy()
    pick = np.lexsort((key, -np.abs(z)))[:VOCABULARY]
    return key[pick], z[pick]


def _near(rows: np.ndarray) -> np.ndarray:
    """Feature rows of a text's words without the words too far from a kept feature to share a filter with it:
    of a run of words without one, as many stay as a filter can cover, so that every activation stays."""
    bare = ~rows.any(axis=0)
    place = np.arange(len(bare))
    run = place - np.maximum.accumulate(np.where(bare, -1, place))
    return rows[:, ~bare | (run < max(WIDTHS))]


def _sparse(sent):
    """Language and kept features of each sampled text: what training needs of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            langs, kept = [], []
            for _, part in _folded(batch.column("text"), SLICE):
                found, hashes = hashed(part)
                rows = model.rows(hashes).astype(np.uint16)
                langs += languages(found, hashes[0]).tolist()
                kept += [_near(rows[:, lo:hi]).tobytes() for lo, hi in zip(found.bounds[:-1], found.bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("label"), pa.array(langs, pa.int32()),
                                              pa.array(kept, pa.binary())], names=["_id", "label", "lang", "kept"])

    return run


def _best_cut(logit: np.ndarray, y: np.ndarray, share: float) -> float | None:
    """The logit that errs least when classes are weighted by their share among labelled rows."""
    by = np.argsort(logit)
    return _counted_cut(logit[by], (1 - y)[by], y[by], share)


def _counted_cut(logit: np.ndarray, n0: np.ndarray, n1: np.ndarray, share: float) -> float | None:
    """``_best_cut`` of ascending logits that ``n0`` and ``n1`` rows of each class have."""
    if n1.sum() < 10 or n0.sum() < 10:
        return None
    w1, w0 = share / n1.sum(), (1 - share) / n0.sum()
    missed = np.concatenate(([0], np.cumsum(n1 * w1)))
    wrong = np.concatenate((np.cumsum((n0 * w0)[::-1])[::-1], [0]))
    at = np.flatnonzero(missed + wrong <= (missed + wrong).min() + 1e-12)
    edges = np.concatenate(([logit[0] - 2], logit[:-1] + NEARER * np.diff(logit), [logit[-1] + 2]))
    wide = np.concatenate(([0], np.diff(logit), [0]))[at]
    return float(edges[at[int(np.argmax(wide))]])


def _start(keys: np.ndarray, z: np.ndarray, rng) -> Model:
    """The parameters that training starts from."""
    embed = rng.normal(0, 0.1, (len(keys) + 1, DIMENSIONS)).astype(np.float32)
    embed[1:, 0] = np.clip(z / 10, -1, 1)
    embed[0] = 0
    return Model(keys, embed,
                 [rng.normal(0, 0.5, (w * DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
                 [np.full(FILTERS, 0.05, np.float32) for _ in WIDTHS],
                 rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 0.0, np.zeros(len(FUNCTION_WORDS)), 0.0)


def _in_doubles(model: Model) -> None:
    """After training: a score must not depend on the rows that share its slice."""
    model.embed, model.out = model.embed.astype(float), model.out.astype(float)
    model.filters, model.bias = [f.astype(float) for f in model.filters], [b.astype(float) for b in model.bias]


def fit(keys: np.ndarray, z: np.ndarray, docs: list[np.ndarray], langs: np.ndarray, labels: np.ndarray, share: float,
        seed: int = 2) -> Model | None:
    """Train on the rows of kept features (``keys`` and ``z``) of each text, its language and its 0/1 label; ``share`` is
    the share of label 1 among all labelled rows. None when a class is missing."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    by = rng.permutation(len(y))
    docs, langs, y = [docs[i] for i in by], langs[by], y[by]
    model = _start(keys, z, rng)
    held = np.arange(len(y)) % 4 == 0  # calibration rows
    _train(model, docs, y, np.flatnonzero(~held), rng)
    _in_doubles(model)
    logit = np.concatenate([model.logits(*_joined(docs[i:i + 256])) for i in range(0, len(docs), 256)])
    cal = held if _best_cut(logit[held], y[held], share) is not None else np.ones(len(y), bool)
    whole = _best_cut(logit[cal], y[cal], share)
    model.default_cut = whole if whole is not None else 0.0
    for k in range(len(FUNCTION_WORDS)):
        own = cal & (langs == k)
        cut = _best_cut(logit[own], y[own], share)
        model.cuts[k] = cut if cut is not None else model.default_cut
    return model


def _joined(docs: list[np.ndarray]) -> tuple[T.Words, np.ndarray]:
    bounds = np.concatenate(([0], np.cumsum([d.shape[1] for d in docs])))
    return T.Words(bounds[:0], bounds[:0], bounds), np.concatenate(docs, axis=1)


def _params(model: Model) -> list[np.ndarray]:
    return [model.embed, *model.filters, *model.bias, model.out]


def _train(model: Model, docs: list, y: np.ndarray, use: np.ndarray, rng, rate: float = 0.1, batch: int = 64,
           epochs: int = EPOCHS, sums: list[np.ndarray] | None = None, total: float = 0.0, share: float | None = None) -> float:
    """Adagrad on the logistic loss; classes weigh the same; gradients follow the pooled places. ``sums`` and ``total`` hold
    the squared gradients so far (``sums`` is added to, the new total returned), ``share`` is label 1's share of all rows."""
    ones = y[use].mean() if share is None else share
    weight = np.where(y == 1, 0.5 / max(ones, 1e-9), 0.5 / max(1 - ones, 1e-9))
    params = _params(model)
    sums = [np.full_like(p, 1e-2) for p in params] if sums is None else sums

    def step(k: int, grad: np.ndarray) -> None:
        sums[k] += grad * grad
        params[k] -= rate * grad / np.sqrt(sums[k])

    for _ in range(epochs):
        for at in np.array_split(rng.permutation(use), max(1, len(use) // batch)):
            found, rows = _joined([docs[i] for i in at])
            # each of a word's three rows must do without the others, so that new forms of a word count
            rows = np.where(rng.random(rows.shape) < DROPPED, 0, rows)
            pre, place = model.pooled(found, rows, arg=True)
            hidden = np.maximum(pre, 0)
            logit = hidden @ model.out + model.out_bias
            error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y[at]) * weight[at] / len(at)
            back = np.outer(error, model.out) * (pre > 0)
            g_embed = np.zeros_like(model.embed)
            grads_w, grads_b = [], []
            for m, width in enumerate(WIDTHS):
                span = slice(m * FILTERS, (m + 1) * FILTERS)
                d, p = back[:, span], place[:, span]
                grads_b.append(d.sum(axis=0).astype(np.float32))
                g = np.zeros_like(model.filters[m])
                doc, f = np.nonzero((p >= 0) & (d != 0))
                for j in range(width):
                    q = p[doc, f] + j
                    ok = q < found.bounds[doc + 1]
                    dd, ff, qq = d[doc, f][ok], f[ok], q[ok]
                    ids = rows[:, qq]
                    x = model.embed[ids].sum(axis=0)
                    np.add.at(g[j * DIMENSIONS:(j + 1) * DIMENSIONS].T, ff, x * dd[:, None])
                    flow = model.filters[m][j * DIMENSIONS:(j + 1) * DIMENSIONS].T[ff] * dd[:, None]
                    for r in ids:
                        np.add.at(g_embed, r, flow)
                grads_w.append(g)
            g_embed[0] = 0
            step(0, g_embed)
            for m in range(len(WIDTHS)):
                step(1 + m, grads_w[m])
                step(1 + len(WIDTHS) + m, grads_b[m])
            step(len(params) - 1, (error @ hidden).astype(np.float32))
            g = float(error.sum())
            total += g * g
            model.out_bias -= rate * g / np.sqrt(total + 1e-2)
    return total


def _gathered(table: pa.Table) -> pa.Table:
    """One row of a part's rows: labels, languages, calibration marks, and the kept features end to end."""
    by = np.argsort(table.column("_id").to_numpy(), kind="stable")
    kept = table.column("kept").to_pylist()
    one = {"part": table.column("part")[0].as_py(), "labels": table.column("label").to_numpy()[by].astype(np.int8).tobytes(),
           "langs": table.column("lang").to_numpy()[by].astype(np.int8).tobytes(),
           "held": table.column("held").to_numpy()[by].astype(np.int8).tobytes(),
           "sizes": np.array([len(kept[i]) for i in by], np.int64).tobytes(), "kept": b"".join(kept[i] for i in by)}
    return pa.Table.from_pylist([one], pa.schema([("part", pa.int64()), *[(n, pa.binary()) for n in list(one)[1:]]]))


def _parts(batches: Iterator[pa.RecordBatch]):
    """Number, labels, languages, calibration marks and kept features of each part."""
    for batch in batches:
        for k in range(batch.num_rows):
            get = lambda name, kind: np.frombuffer(batch.column(name)[k].as_py(), kind)
            whole, ends = batch.column("kept")[k].as_py(), np.cumsum(get("sizes", np.int64))
            docs = [np.frombuffer(whole[lo:hi], np.uint16).reshape(3, -1) for lo, hi in zip([0, *ends[:-1]], ends)]
            yield batch.column("part")[k].as_py(), get("labels", np.int8).astype(float), get("langs", np.int8), get("held", np.int8) == 1, docs


def _epoch(sent, epoch: int, share: float, seed: int):
    """The parameters after one epoch on a part's rows: blocks of embedding rows (changed or not, row, squared gradients) and, as
    block -1, all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, y, _, held, docs in _parts(batches):
            use = np.flatnonzero(~held)
            if not len(use):
                continue
            model, sums, total = deepcopy(sent.value)  # the worker keeps the broadcast for later tasks
            before = model.embed.copy()
            total = _train(model, docs, y, use, np.random.default_rng([seed, epoch, part]), epochs=1, sums=sums, total=total, share=share)
            rows = np.concatenate(((model.embed != before).any(axis=1)[:, None], model.embed, sums[0]), axis=1).astype(np.float32)
            blocks = [rows[k:k + BLOCK] for k in range(0, len(rows), BLOCK)]
            blocks.append(np.concatenate([*[x.ravel() for x in (*_params(model)[1:], *sums[1:])], [model.out_bias, total]]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array([*range(len(blocks) - 1), -1]), pa.array([part] * len(blocks)),
                                              pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "part", "vals"])

    return run


def _averaged(table: pa.Table) -> pa.Table:
    """The mean of a block's parameters over the parts; of an embedding row over the parts that changed it."""
    by = np.argsort(table.column("part").to_numpy())  # a sum must not depend on the order of its parts
    vals, count, total = table.column("vals").to_pylist(), 0.0, 0.0
    rows = table.column("block")[0].as_py() >= 0
    for i in by:
        v = np.frombuffer(vals[i], np.float32).astype(float)
        if rows:
            v = v.reshape(-1, 1 + 2 * DIMENSIONS)
            changed = v[:, :1]
            total, count = total + v * changed, count + changed
        else:
            total, count = total + v, count + 1
    mean = (total / np.maximum(count, 1)).astype(np.float32)
    return pa.table({"block": table.column("block")[:1], "vals": pa.array([mean.tobytes()], pa.binary())})


def _logit_counts(sent):
    """Rows of a part by calibration mark, language, label and rounded logit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for _, y, langs, held, docs in _parts(batches):
            logit = np.concatenate([model.logits(*_joined(docs[i:i + 256])) for i in range(0, len(docs), 256)])
            cents = np.round(np.clip(logit, -FARTHEST, FARTHEST) * 10 ** DIGITS).astype(np.int64)
            found, n = np.unique(np.stack((held, langs, y, cents)).astype(np.int64), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in found], pa.array(n)], names=["held", "lang", "label", "cents", "n"])

    return run


def fit_in_parts(sparse: DataFrame, keys: np.ndarray, z: np.ndarray, rows: int, ones: float, share: float, folder: str,
                 part_rows: int = PART_ROWS, seed: int = 2) -> Model:
    """``fit`` for more rows than one task trains on: ``sparse`` has _id, label, lang and kept features of ``rows`` rows, of which
    the share ``ones`` has label 1. The driver gets parameters and counts of logits."""
    spark = sparse.sparkSession
    sparse = T.stored(sparse, f"{folder}/sparse")
    size = sparse.agg(F.sum(F.octet_length("kept"))).first()[0]
    parts = max(-(-rows // part_rows), size // PART_BYTES)
    dealt = sparse.select("*", F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(parts)).alias("part"), (F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(4)) == 0).cast("int").alias("held"))
    gathered = T.stored(dealt.groupBy("part").applyInArrow(
        _gathered, "part long, labels binary, langs binary, held binary, sizes binary, kept binary"), f"{folder}/parts")
    model, total = _start(keys, z, np.random.default_rng(seed)), 0.0
    sums = [np.full_like(p, 1e-2) for p in _params(model)]
    for epoch in range(EPOCHS):
        sent = spark.sparkContext.broadcast((model, sums, total))
        steps = T.mapped(gathered, _epoch(sent, epoch, ones, seed), "block long, part long, vals binary")
        got = {r["block"]: np.frombuffer(r["vals"], np.float32).copy()
               for r in steps.groupBy("block").applyInArrow(_averaged, "block long, vals binary").collect()}
        mean = np.concatenate([got[k].reshape(-1, 1 + 2 * DIMENSIONS) for k in range(len(got) - 1)])
        changed = mean[:, 0] > 0
        model.embed[changed], sums[0][changed] = mean[changed, 1:1 + DIMENSIONS], mean[changed, 1 + DIMENSIONS:]
        at = 0
        for x in (*_params(model)[1:], *sums[1:]):
            x[...] = got[-1][at:at + x.size].reshape(x.shape)
            at += x.size
        model.out_bias, total = float(got[-1][-2]), float(got[-1][-1])
    _in_doubles(model)
    counts = T.mapped(gathered, _logit_counts(spark.sparkContext.broadcast(model)), "held long, lang long, label long, cents long, n long")
    table = counts.groupBy("held", "lang", "label", "cents").agg(F.sum("n").alias("n")).toPandas()

    def cut(of) -> float | None:
        both = of.groupby(["cents", "label"])["n"].sum().unstack(fill_value=0).reindex(columns=[0, 1], fill_value=0).sort_index()
        return _counted_cut(both.index.to_numpy() / 10 ** DIGITS, both[0].to_numpy(float), both[1].to_numpy(float), share)

    cal = table[table.held == 1]
    cal = cal if cut(cal) is not None else table
    whole = cut(cal)
    model.default_cut = whole if whole is not None else 0.0
    for k in range(len(FUNCTION_WORDS)):
        own = cut(cal[cal.lang == k])
        model.cuts[k] = own if own is not None else model.default_cut
    return model


def train(docs: DataFrame, labels: DataFrame, learn, part_rows: int = PART_ROWS) -> Model | None:
    """Fit on all rows of ``labels.toxic`` (0/1) over the ids that the condition ``learn`` admits. Tasks hash the
    texts, whole; the features that differ most reach the driver, and the kept features' places in up to ``part_rows`` rows;
    with more rows these stay in the tasks."""
    spark = docs.sparkSession
    found, counts = marked(labels, "toxic", learn)
    folder = T.new_folder(spark, "toxicity")
    rows = docs.where(learn).select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("hash"), "text")
    sample = T.stored(one_per_id(rows.join(found, "_id"), "hash", "text"), f"{folder}/learned")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    keys, z = _features(sample, sizes[0], sizes[1])
    none = np.zeros(0, np.float32)
    sent = spark.sparkContext.broadcast(Model(keys, none, [], [], none, 0.0, none, 0.0))
    sparse = T.mapped(sample, _sparse(sent), "_id long, label int, lang int, kept binary")
    total, share = sizes[0] + sizes[1], counts.get(1, 0) / max(1, sum(counts.values()))
    if total > part_rows:
        return fit_in_parts(sparse, keys, z, total, sizes[1] / total, share, folder, part_rows)
    got = sparse.toPandas().sort_values(["_id", "lang", "kept"])
    kept = [np.frombuffer(x, np.uint16).reshape(3, -1) for x in got.kept]
    return fit(keys, z, kept, got.lang.to_numpy(), got.label.to_numpy(), share)


def _scored(sent, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = sent.value
        for batch in batches:
            texts = batch.column("text")
            scores = [np.zeros(0)]
            for _, part in _folded(texts):
                scores.append(model.scores(part) if model else np.zeros(part.rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))],
                                             names=[*batch.schema.names, name])

    return run


def scored(docs: DataFrame, labels: DataFrame, learn, name: str = "score") -> DataFrame:
    """``docs`` (with a text column) plus their scores in a column ``name``; one pass, no shuffle."""
    model = train(docs, labels, learn)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return T.mapped(docs, _scored(sent, name), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted (1 where score >= ``THRESHOLD``).

    Learns from labelled rows outside the held-out fold. Null and blank texts get the score of a text
    without known words; with no labels of either class every score is 0. Repeated rows and null
    ids are rows like others; columns other than doc_id and text are ignored.
    """
    fold = T.split_share(F.col("doc_id"), folds)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(rows, labels, fold != held_out)
    return out.select("doc_id", (fold == held_out).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
