import hashlib
import random

import pytest

from pullscope.llm.exact import exact_dedup, normalise


def brute(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(normalise(text), []).append(((doc_id is None, doc_id or 0), i))
    out = []
    for text, members in groups.items():
        first = min(members)
        keep = rows[first[1]][0]
        out += [(rows[i][0], keep, len(members), hashlib.sha256(text.encode()).hexdigest()) for _, i in members]
    return out


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_groups_are_those_of_equal_texts(frame, odd_rows, block):
    rng = random.Random(block)
    rows = [r for r in odd_rows if len(r[1] or "") < 1000 or block > 1000]
    pool = ["".join(rng.choice("ab \t") for _ in range(rng.randrange(40))) for _ in range(30)]
    rows += [(100 + i, rng.choice(pool) + rng.choice(["", " ", "x"])) for i in range(150)]
    rows += [(500 + i, "hot text " * 30) for i in range(80)]
    got = exact_dedup(frame(rows, wide=True), block).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=key) == sorted(brute(rows), key=key)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in got}) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_texts_that_differ_only_at_block_edges(frame):
    rows = [(1, "a" * 8), (2, "a" * 9), (3, "a" * 8 + "b"), (4, "a" * 8), (5, "b" + "a" * 8), (6, "a" * 16)]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup(frame(rows), 4).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5, 6: 6}


def test_empty_table(frame):
    assert exact_dedup(frame([])).count() == 0
