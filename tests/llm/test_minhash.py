import random
import re

import pytest

from pullscope.llm.minhash import near_dedup, one_of_each


def brute(rows, width=5, percent=75):
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), low[find(i)]) for i in range(len(rows))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies at all similarities, a chain, a large group of near copies, and unrelated texts."""
    rng = random.Random(1)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 30, 120, 300]))]
        rows.append(" ".join(base))
        for _ in range(5):
            rows.append(edited(rng, base, rng.randrange(0, max(2, len(base) // 12))))
    hot = [f"h{i}" for i in range(200)]
    rows += [edited(rng, hot, rng.randrange(0, 5)) for _ in range(150)]
    step = [f"c{i}" for i in range(100)]
    for k in range(8):
        step = edited(rng, step, 2).split()
        rows.append(" ".join(step))
    rows += [f"unrelated {i} text with few words of its own {i * 7}" for i in range(30)] + ["THE Cat sat on a mat", "the cat SAT on a mat"]
    return [(1000 - i if i % 2 else i, t) for i, t in enumerate(rows)]


def test_components_are_those_of_all_pairs(frame, corpus):
    got = near_dedup(frame(corpus)).collect()
    want = brute(corpus)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(want)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_odd_rows(frame, odd_rows):
    got = near_dedup(frame(odd_rows, wide=True)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(
        [(i, n, None if n == 0 and i is None else c if n else i) for i, n, c in brute(odd_rows)], key=key)
    assert sum(r["kept"] for r in got if r["doc_id"] in (4, 5)) == 1
    assert all(r["kept"] for r in got if r["n_shingles"] == 0)
    assert near_dedup(frame([])).count() == 0


def test_one_row_of_each_group_stays(frame, corpus, odd_rows):
    docs = frame(corpus + corpus[:40])
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted({c for _, _, c in brute(corpus)})
    wide = frame(odd_rows, wide=True)
    left = one_of_each(wide)
    assert left.columns == wide.columns
    texts = [r["text"] for r in left.collect()]
    assert texts.count("one") == 1 and len(texts) == 9


def test_rows_without_own_id_meet_their_own_text_only(spark, frame, monkeypatch):
    """2000 rows of one id (and of none) with different texts: each class's text is shingled once, not once per row."""
    from pullscope.llm import minhash
    rng = random.Random(8)
    rows = []
    for i in range(1000):
        base = [f"v{rng.randrange(10**6)}" for _ in range(20)]
        rows += [(None if i % 2 else 7, " ".join(base)), (None if i % 2 else 7, " ".join([*base, "tail"]))]
    seen = []
    true = minhash.mapped
    monkeypatch.setattr(minhash, "mapped", lambda df, f, schema: (seen.append(df) if "array<long>" in str(schema) else None, true(df, f, schema))[1])
    got = near_dedup(frame(rows))
    assert got.count() == 2000
    assert sum(df.count() for df in seen) <= 2000


def test_lists_of_one_root_and_their_majority_are_not_joined_with_themselves(spark, frame):
    """A large group of near copies and one foreign text in its lists: pairs stay a small multiple of the rows."""
    from pullscope.llm import minhash
    rng = random.Random(9)
    shared = [f"t{k}" for k in range(60)]
    sets, unsettled = [], []
    for i in range(400):
        own = [rng.randrange(10**9) for _ in range(5)] + [hash(x) % 10**9 for x in shared]
        sets.append((i, own))
        unsettled.append((i, 0 if i < 397 else i))
    a = spark.createDataFrame(sets, "rid long, shingles array<long>")
    b = spark.createDataFrame(unsettled, "rid long, root long")
    pairs = minhash._across(b, a, 75, minhash.new_folder(spark, "across-test")).collect()
    assert 0 < len(pairs) <= 3 * 400
    assert {(r["a"], r["b"]) for r in pairs} == {(i, j) for i in range(400) for j in (397, 398, 399) if i < j}
