"""Periodic runs of words: repeated words, phrases or passages that follow each other directly.

A run is a maximal stretch of words with smallest period q (words q apart are equal) and a length of at
least ``least`` words and ``times * q``. All runs of a text are found on a harmonic grid: a stretch
of period p and length ``times * p`` holds a place i that is a multiple of ``(times - 1) * p`` with both i and i + p
inside. For every p the places of the grid are tried: how far the words from i and from i + p agree, to
the right and to the left, is the run. There are about n * ln(n) / (times - 1) places for n words.

"How far" is a longest common extension (LCE) over a difference cover: a set of places modulo 13 such
that for any two places the same shift of at most 12 words brings both into it. So few words are compared
directly, and if none differ, the rest is the common prefix of two sampled suffixes. Only suffixes at
places of the cover are sorted (4 of 13): each is a row of 13 words, rows are named by sorting, and the names of the
same residue follow each other in one reduced string that is sorted by doubling. The common prefix of two
suffixes is the least of the neighbours' common prefixes between them, from a sparse table. To the left the
same structure stands on the reversed words. Most pairs differ within the directly compared words;
suffixes are sorted for the texts of the other pairs only.

Texts are handled inside ``mapInArrow``, a slice of rows at once: the words of a slice are numbered exactly
(equal numbers mean equal words) and laid out one after the other, longest text first, with a number
between texts that occurs once, so that no run crosses them and each p tries only texts that are long enough.
No row leaves its partition. A task holds one slice (about 2 MB of text, one longer text alone).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.text import mapped, slices

#: A difference cover: every difference modulo PERIOD is one of two of its places.
PERIOD = 13
COVER = (0, 1, 3, 9)
LEAST = 6
TIMES = 4
#: Pairs of places handled at once.
PAIRS = 1 << 20

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: _SHIFT[a, b]: least shift that brings places with the residues a and b into the cover.
_SHIFT = np.array([[min(s for s in range(PERIOD) if _IN_COVER[(a + s) % PERIOD] and _IN_COVER[(b + s) % PERIOD])
                    for b in range(PERIOD)] for a in range(PERIOD)])


def _names(rows: np.ndarray) -> np.ndarray:
    """Names of rows that sort like them; equal rows have equal names."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.concatenate([[0], (ordered[1:] != ordered[:-1]).any(axis=1)])
    out = np.empty(len(rows), np.int64)
    out[order] = np.cumsum(new)
    return out


class Extensions:
    """Longest common extensions to the right of places in ``words`` (numbers from 0; -1 ends the string)."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        # numbers below 0 after the end are all different, so that no extension goes past it
        self.words = np.concatenate([words, -1 - np.arange(2 * PERIOD + 1, dtype=words.dtype)])
        self.table: list[np.ndarray] | None = None

    def _sort(self) -> None:
        """Sort the suffixes at places of the cover; ``rank`` of each and the common prefixes of neighbours."""
        n = self.n
        places = [np.arange(c, n + PERIOD, PERIOD) for c in COVER]  # a row after the end closes each residue's part
        at = np.concatenate(places)
        inside = np.minimum(at[:, None] + np.arange(PERIOD), n + 2 * PERIOD)
        rows = self.words[inside]
        rows[inside >= n] = -1
        for part, row in zip(range(len(COVER)), np.cumsum([len(p) for p in places]) - 1, strict=True):
            rows[row] = -2 - part  # unlike any other row
        name = _names(rows)
        m = len(at)
        levels = [name]
        step = 1
        while name.max() + 1 < m:
            after = np.full(m, -1, np.int64)
            after[:m - step] = name[step:]
            name = _names(np.column_stack([name, after]))
            levels.append(name)
            step *= 2
        order = np.argsort(name)
        # common rows of neighbours by descending the levels, then common words of the first unequal row
        a, b = order[:-1].copy(), order[1:].copy()
        same = np.zeros(m - 1, np.int64)
        for k in range(len(levels) - 2, -1, -1):
            inner = (a < m) & (b < m)
            equal = np.zeros(m - 1, bool)
            equal[inner] = levels[k][a[inner]] == levels[k][b[inner]]
            jump = equal * (1 << k)
            a, b, same = a + jump, b + jump, same + jump
        common = same * PERIOD
        differ = rows[np.minimum(a, m - 1)] != rows[np.minimum(b, m - 1)]
        common += np.where(differ.any(axis=1), differ.argmax(axis=1), 0)
        self.rank = np.full(n + PERIOD, -1, np.int64)
        self.rank[at] = name
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _prefix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefixes of sampled suffixes at different places."""
        if self.table is None:
            self._sort()
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        k = np.frexp((b - a).astype(float))[1] - 1
        out = np.empty(len(i), np.int64)
        for level in np.unique(k):
            on = k == level
            row = self.table[level]
            out[on] = np.minimum(row[a[on]], row[b[on] - (1 << level)])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from the different places i and j on."""
        shift = _SHIFT[i % PERIOD, j % PERIOD]
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for s in range(PERIOD):
            live = live[(s < shift[live]) & (np.maximum(i[live], j[live]) + s < self.n)]
            live = live[self.words[i[live] + s] == self.words[j[live] + s]]
            if not len(live):
                break
            out[live] += 1
        reach = np.flatnonzero((out == shift) & (np.maximum(i, j) + shift < self.n))
        if len(reach):
            out[reach] += self._prefix(i[reach] + shift[reach], j[reach] + shift[reach])
        return out


class _Lazy:
    """Extensions to both sides over several texts; suffixes are sorted only for the texts that need it."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        self.words, self.bounds, self.made = words, bounds, {}

    def __call__(self, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """Common words of the places before i and j (``back``) or from them on, within their text."""
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for s in range(PERIOD):
            a, b = (i[live] - 1 - s, j[live] - 1 - s) if back else (i[live] + s, j[live] + s)
            same = (a >= 0) & (b < len(self.words))
            same[same] = self.words[a[same]] == self.words[b[same]]
            live = live[same]
            if not len(live):
                return out
            out[live] += 1
        text = np.searchsorted(self.bounds, i[live], side="right") - 1
        for t in np.unique(text):
            on = live[text == t]
            first, last = self.bounds[t], self.bounds[t + 1]
            if (t, back) not in self.made:
                part = self.words[first:last]
                self.made[t, back] = Extensions(part[::-1].copy() if back else part)
            a, b = (last - i[on], last - j[on]) if back else (i[on] - first, j[on] - first)
            ends = np.maximum(a, b) >= last - first
            out[on] = 0
            on, a, b = on[~ends], a[~ends], b[~ends]
            out[on] = self.made[t, back](a, b)
        return out


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of texts laid out in ``words``: (start, length, period) arrays, sorted by start, then period.

    Text t is ``bounds[t] .. bounds[t + 1]``, the longest first, its last place a number that occurs nowhere else.
    """
    lengths = np.diff(bounds) - 1
    none = np.zeros(0, np.int64)
    longest = int(lengths.max(initial=0))
    extend = _Lazy(words, bounds)
    found = [(none, none, none)]
    p = 1
    while p * times <= longest and longest >= least:
        # several periods at once: the places of the grid in the texts that are long enough
        periods, starts, size = [], [], 0
        while p * times <= longest and size < PAIRS:
            within = int(bounds[np.searchsorted(-lengths, -max(least, p * times), side="right")])
            grid = np.arange(0, within, (times - 1) * p)
            starts.append(grid)
            periods.append(np.full(len(grid), p))
            size += len(grid)
            p += 1
        i, period = np.concatenate(starts), np.concatenate(periods)
        j = i + period
        inside = j < len(words)
        i, j, period = i[inside], j[inside], period[inside]
        same = words[i] == words[j]
        i, j, period = i[same], j[same], period[same]
        right = extend(i, j, False)
        left = extend(i, j, True)
        length = left + right + period
        good = length >= np.maximum(least, times * period)
        found.append(((i - left)[good], length[good], period[good]))
    start, length, period = (np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # one stretch has one smallest period; the grid finds a run several times, and with multiples of its period
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def looped(words: list, doc_id: int | None) -> list:
    """The planted loops of the registered query: of one id in ten (by crc32) the words repeat from some place on."""
    h = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _runs(change: Callable[[list, int | None], list] | None, least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text")):
                yield _slice([part.data[a:b].tobytes() for a, b in zip(part.offsets, part.offsets[1:], strict=False)],
                             ids[part.first:part.last])

    def _slice(texts: list[bytes], ids: list) -> pa.RecordBatch:
        # bytes.split() cuts at exactly the six blanks
        docs = [t.split() for t in texts]
        if change is not None:
            docs = [change(w, i) for w, i in zip(docs, ids, strict=True)]
        counts = np.array([len(w) for w in docs], np.int64)
        order = np.argsort(-counts, kind="stable")
        every = np.empty(int(counts.sum()), object)
        every[:] = [w for k in order for w in docs[k]]
        numbers = pd.factorize(every)[0] if len(every) else np.zeros(0, np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts[order] + 1)])
        words = np.empty(bounds[-1], np.int64)
        ends = np.zeros(len(words), bool)
        ends[bounds[1:] - 1] = True
        words[~ends] = numbers
        words[ends] = len(every) + np.arange(len(docs))
        start, length, period = find_runs(words, bounds, least, times)
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, start + length, -1)
        keep = np.cumsum(gone[:-1]) == 0
        cuts = np.searchsorted(start, bounds)
        out: list = [None] * len(docs)
        for place, k in enumerate(order):
            first, a, b = bounds[place], cuts[place], cuts[place + 1]
            own = [(int(s - first), int(m), int(q)) for s, m, q in zip(start[a:b], length[a:b], period[a:b], strict=True)]
            if own:
                best = min(own, key=lambda r: (-r[1], r[0], r[2]))
                left = [w for w, stay in zip(docs[k], keep[first:bounds[place + 1] - 1], strict=True) if stay]
            else:
                best, left = (None, None, None), docs[k]
            listed = "".join(f"{s},{m},{q}\n" for s, m, q in own)
            out[k] = (ids[k], len(own), *best, None if best[1] is None else 1000 * best[1] // best[2],
                      hashlib.sha256(listed.encode()).hexdigest(), listed, b" ".join(left))
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64()] * 6 + [pa.string(), pa.string(), pa.string()]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "runs", "collapsed"]
        return pa.RecordBatch.from_arrays([pa.array(c if n != "collapsed" else [x.decode() for x in c], t)
                                           for c, t, n in zip(cols, kinds, names, strict=True)], names=names)

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES,
                  change: Callable[[list, int | None], list] | None = None) -> DataFrame:
    """Per input row: doc_id, n_runs; start (word number), length, period and exponent_milli
    (floor(1000 * length / period)) of the longest run (ties: smallest start, then period; null without a
    run); runs (every run's ``start,length,period`` and a line feed, by start, then period), its
    runs_sha256, and collapsed: the words, joined by one space, without those that a run contains
    after its first ``period`` words.

    Words are the runs ``[^\\x20\\x09-\\x0D]+``, unchanged, of the whole text. Null, empty and blank texts have no word:
    no run and an empty text. Repeated rows and null ids are rows like others. ``change`` (words, doc_id)
    may give other words of a document first. Columns other than doc_id and text are not looked at. An empty
    table gives an empty table.
    """
    if times < 3 or least < 1:
        raise ValueError("runs need at least three periods and one word")
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _runs(change, least, times),
                  "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
                  "runs string, collapsed string")
