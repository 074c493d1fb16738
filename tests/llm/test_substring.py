import hashlib
import random
import re

import pytest

from pullscope.llm import substring
from pullscope.llm.substring import Automaton, covered, substring_dedup


def brute(rows, window=35):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for w in docs:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (doc_id, _), w in zip(rows, docs):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def spans_of(text, words, least):
    a = Automaton()
    for t in text:
        a.add(t)
    here, there = a.matches(words, least)
    flat = [w for t in text for w in (*t, None)]
    for i, j in zip(here, there):  # the first place where these words end
        one = words[i - least + 1:i + 1]
        assert flat[j - least + 1:j + 1] == one
    return list(covered(here, least))


def test_automaton_spans():
    assert spans_of([[1, 2, 3, 4], [3, 4, 5]], [9, 2, 3, 4, 5, 9, 1, 2, 3, 4], 3) == [(1, 5), (6, 10)]
    assert spans_of([[1, 2, 3]], [1, 2, 9, 2, 3], 3) == []
    assert spans_of([[1, 1, 1, 1]], [1] * 10, 4) == [(0, 10)]
    rng = random.Random(3)
    for _ in range(60):
        ref = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        words, n = [rng.randrange(3) for _ in range(25)], rng.randrange(1, 5)
        there = {tuple(r[i:i + n]) for r in ref for i in range(len(r) - n + 1)}
        cover = [False] * 25
        for i in range(25 - n + 1):
            if tuple(words[i:i + n]) in there:
                cover[i:i + n] = [True] * n
        got = [False] * 25
        for lo, hi in spans_of(ref, words, n):
            got[lo:hi] = [True] * (hi - lo)
        assert got == cover


@pytest.mark.parametrize("window,anchor,shard,hot", [(35, 18, 20_000, 1000), (6, 3, 15, 4), (4, 2, 1000, 2), (35, 18, 100, 3)])
def test_removed_words_are_those_of_brute_force(frame, odd_rows, window, anchor, shard, hot):
    rng = random.Random(window)
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    shared = [make(rng.randrange(window - 2, 3 * window)) for _ in range(6)]
    rows = [r for r in odd_rows if len(r[1] or "") < 1000]
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += make(rng.randrange(0, 60)) + (rng.choice(shared) if rng.random() < .6 else [])
        rows.append((100 + i, rng.choice(["", " "]) + "  ".join(parts)))
    rows += [(300 + i, " ".join(shared[0])) for i in range(15)]  # a hot passage, and copies
    rows += [(400, " ".join(["same"] * (window + 3))), (401, " ".join(["same"] * window)), (402, " ".join(make(window) * 2))]
    got = substring_dedup(frame(rows, wide=True), window, anchor=anchor, shard_words=shard, hot_pieces=hot).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(rows, window), key=key)


def test_very_long_and_empty(frame, odd_rows):
    got = substring_dedup(frame(odd_rows)).collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(odd_rows), key=key)
    assert substring_dedup(frame([])).count() == 0


def test_the_automata_alone_find_the_repeats(frame, monkeypatch):
    """Without matches nothing is removed but copies: no other step decides."""
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(i, f"{' '.join(str(rng.randrange(10**6)) for _ in range(20))} {passage} tail{i}") for i in range(20)]
    assert {r["n_removed"] for r in substring_dedup(frame(rows)).collect()} == {50}
    run = substring._matched

    def off(window, shard_words):
        return run(10**6, shard_words)

    monkeypatch.setattr(substring, "_matched", off)
    assert {r["n_removed"] for r in substring_dedup(frame(rows)).collect()} == {0}


def test_a_common_phrase_before_different_texts(frame):
    """A phrase of an anchor's length in many documents, each going on by itself: several shards, and a second round."""
    rng = random.Random(6)
    phrase = [f"c{k}" for k in range(22)]
    own = lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    long = phrase + own(20)
    rows = [(i, " ".join(own(15) + (long if i % 10 == 0 else phrase) + own(15))) for i in range(200)]
    got = substring_dedup(frame(rows), hot_pieces=7).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
    assert {r["n_removed"] for r in got} == {0, 42}
