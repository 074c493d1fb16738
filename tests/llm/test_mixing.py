import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pullscope.llm.mixing import fit, mix, mixed_documents


def goals(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing, as the contract tells it. sizes: source -> words."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    open_, out, left = set(names), {}, float(sum(sizes.values()))
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def sums(sizes, counts, most):
    reach = {0}
    for a, c in zip(sizes, counts):
        reach = {r + k * a for r in reach for k in range(c + 1) if r + k * a <= most}
    return reach


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=12), st.integers(0, 4000), st.sampled_from([5, 100, 1 << 16]))
def test_fit_comes_nearest_to_the_budget(lengths, budget, window):
    sizes, counts = list(lengths), list(lengths.values())
    take = fit(sizes, counts, budget, window)
    got = sum(a * b for a, b in zip(sizes, take))
    assert all(0 <= t <= c for t, c in zip(take, counts))
    total = sum(a * b for a, b in zip(sizes, counts))
    if budget >= total:
        assert take == counts
    elif window >= budget:  # no set of documents comes nearer
        assert abs(got - budget) == min(abs(x - budget) for x in sums(sizes, counts, 2 * budget + 60))
    else:
        assert abs(got - budget) <= max(sizes)


def test_fit_finds_sums_beside_the_proportional_shares():
    assert fit([7, 12], [4, 1], 12) == [0, 1]
    assert fit([20_000], [1], 19_000) == [1]  # nearer from above
    assert fit([20_000], [1], 9_000) == [0]
    assert fit([3, 5], [10, 10], 1) == [0, 0]
    # a large budget: the last words are fitted with the documents that the shares left over
    sizes, counts = [7, 11, 13, 1000], [50_000, 40_000, 30_000, 900]
    for budget in (1_000_003, 777_777, 1_500_001):
        assert sum(a * b for a, b in zip(sizes, fit(sizes, counts, budget))) == budget


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(900):
        source = rng.choice(["b", "a", "é", None, "", "tiny"]) if i % 3 else "hot"
        n = 1 if source == "tiny" and i % 50 else rng.choice([0, 1, 3, 3, 3, 8, 40, 120])
        out.append((i, " ".join(["w"] * n) if i % 40 else None, "en", source))
    return out


@pytest.mark.parametrize("cell", [5, 100_000])
def test_sizes_targets_and_takings(frame, rows, cell):
    docs = frame(rows, wide=True)
    got = mix(docs, cell_rows=cell).collect()
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = goals(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t, _, _ in rows if i == r["doc_id"])
        assert r["size"] == len(re.findall(r"\S+", text or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 1 + 0.001 * want[s], s
    again = {(r["doc_id"], r["taken"]) for r in mix(docs.repartition(7), cell_rows=cell).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_documents_are_repeated_as_taken(frame, rows, odd_rows):
    docs = frame(rows, wide=True)
    times = {r["doc_id"]: r["repeats"] for r in mix(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r["doc_id"]] += 1
    assert dict(seen) == {k: v for k, v in times.items() if v}
    odd = mix(frame(odd_rows))
    assert odd.count() == len(odd_rows) and mixed_documents(frame(odd_rows)).count() >= 1
    assert mix(frame([])).count() == 0 and mixed_documents(frame([])).count() == 0
    assert all(r["taken"] == 0 and r["target"] == 0 for r in mix(frame([(1, ""), (2, None)])).collect())
