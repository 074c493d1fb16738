import hashlib
import random
import re

import numpy as np
import pytest

from pullscope.llm.runs import Extensions, looped, periodic_runs


def brute(words, least=6, times=4):
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, times * p):
                found.setdefault((start, length), p)
    return sorted((s, m, p) for (s, m), p in found.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(words):
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(),
            " ".join(w for i, w in enumerate(words) if i not in gone))


def texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) * rng.choice([1, 1, 30]) for _ in range(rng.randrange(120))]
        if words and rng.random() < 0.7:
            a = rng.randrange(len(words))
            words = words[:a] + words[a:a + rng.randrange(1, 12)] * rng.randrange(1, 9) + words[a:a + 5]
        yield rng.choice([" ", "\n", " \t"]).join(words)


def test_runs_equal_brute_force(spark, frame):
    rows = list(enumerate(texts(1, 400)))
    got = {r["doc_id"]: r for r in periodic_runs(frame(rows, wide=True)).collect()}
    for doc_id, text in rows:
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["runs_sha256"], r["collapsed"]) == expected(split(text))
    assert sum(r["n_runs"] for r in got.values()) > 100


def test_planted_loops(spark, frame):
    rows = [(i, t) for i, t in enumerate(texts(2, 300))]
    got = {r["doc_id"]: r["n_runs"] for r in periodic_runs(frame(rows), change=looped).collect()}
    changed = 0
    for doc_id, text in rows:
        words = looped(split(text), doc_id)
        assert got[doc_id] == len(brute(words))
        changed += words != split(text)
    assert changed > 10


def test_odd_rows(spark, frame, odd_rows):
    extra = [(20, "x " * 5), (21, "x " * 6), (22, "a b " * 4), (23, "a b a b a b a"), (24, "\x1cx " * 8), (25, "é é " * 7), (26, "x" * 100_000 + " ")]
    got = [(r["doc_id"], r["n_runs"], r["collapsed"]) for r in periodic_runs(frame(odd_rows + extra, wide=True)).collect()]
    want = []
    for doc_id, text in odd_rows + extra:
        words = split(text)
        n, *_, left = expected(words) if len(words) < 1000 else (0, " ".join(words))
        want.append((doc_id, n, left))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by = {i: (n, c) for i, n, c in got}
    assert by[20] == (0, "x x x x x") and by[21] == (1, "x") and by[22] == (1, "a b") and by[23][0] == 0


def test_a_very_long_loop(spark, frame):
    rng = random.Random(3)
    loop = [str(rng.randrange(10**6)) for _ in range(9000)]
    text = " ".join(["start", *loop * 5, "end"])
    r = periodic_runs(frame([(1, text)])).first()
    assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (1, 1, 45000, 9000, 5000)
    assert r["collapsed"] == " ".join(["start", *loop, "end"])


@pytest.mark.parametrize("letters", [1, 2, 20])
def test_extensions_equal_direct_comparison(letters):
    rng = np.random.Generator(np.random.PCG64(letters))
    for n in (1, 2, 14, 60, 333):
        words = rng.integers(letters, size=n)
        if n > 60:
            words = np.tile(words[:40], 9)[:n]
        i, j = np.nonzero(~np.eye(n, dtype=bool))
        got = Extensions(words)(i, j)
        for a, b, m in zip(i, j, got, strict=True):
            k = 0
            while max(a, b) + k < n and words[a + k] == words[b + k]:
                k += 1
            assert m == k, (words, a, b)


def test_empty_table(spark, frame):
    assert periodic_runs(frame([])).count() == 0
