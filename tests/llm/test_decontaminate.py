import itertools
import random
import re

import pytest

from pullscope.llm.decontaminate import MASKS, OVERLAP, SUBSTITUTIONS, clean_documents, leaks


def words(text):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (text or "").casefold())


def brute(rows, items, overlap=13, subs=2, shortest=5):
    out = set()
    for doc_id, text in rows:
        d = words(text)
        for item_id, item in items:
            w = words(item)
            if len(w) < shortest:
                continue
            n, need = (overlap, overlap - subs) if len(w) >= overlap else (len(w), len(w) - (len(w) >= 8))
            best = 0
            for shift in range(-len(w), len(d)):
                same = [0 <= shift + k < len(d) and d[shift + k] == w[k] for k in range(len(w))]
                for k in range(len(w) - n + 1):
                    if shift + k >= 0 and shift + k + n <= len(d):
                        best = max(best, sum(same[k:k + n]))
            if best >= need:
                out.add((doc_id, item_id, best))
    return out


def test_every_overlap_is_hit_by_a_mask():
    for gone in itertools.combinations(range(OVERLAP), SUBSTITUTIONS):
        assert any(all(o + i not in gone for i, c in enumerate(m) if c == "1")
                   for m in MASKS for o in range(OVERLAP - len(m) + 1)), gone


@pytest.fixture(scope="module")
def data():
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "à", "ß"] * 30
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([3, 6, 8, 9, 12, 13, 20, 60])))) for i in range(40)] + [(50, None), (51, ""), (52, items_copy := "same item as another one here")]
    items.append((53, items_copy))
    rows = []
    for i in range(120):
        w = some(rng.randrange(0, 40))
        if i % 2:
            item = words(rng.choice(items[:40])[1])
            lo = rng.randrange(max(1, len(item) - 13))
            part = item[lo:lo + rng.choice([10, 13, 16, 60])]
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = rng.choice(["zz", "of"])
            w = w + part + some(rng.randrange(30))
        text = " ".join(w)
        rows.append((i, text.upper().replace(" ", "!! ") if i % 5 == 0 else text))
    return rows + [(900, "x " + items_copy + "."), (901, items_copy.upper())], items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("bits", [16, 0])  # 0: a filter so small that it drops next to nothing
def test_leaks_are_those_of_brute_force(spark, frame, data, bits):
    rows, items = data
    got = leaks(frame(rows, wide=True), bench(spark, items), bits_per_seed=bits).collect()
    assert {(r["doc_id"], r["item_id"], r["agreeing"]) for r in got} == brute(rows, items) and len(got) == len(brute(rows, items))


def test_clean_documents_and_odd_rows(spark, frame, data, odd_rows):
    rows, items = data
    odd_rows = [(i if i is None else 2000 + i, t) for i, t in odd_rows]
    docs = frame(rows + odd_rows, wide=True)
    left = clean_documents(docs, bench(spark, items))
    assert left.columns == docs.columns
    bad = {d for d, _, _ in brute(rows, items)}
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in rows + odd_rows if i not in bad)
    assert clean_documents(docs, bench(spark, [])).count() == docs.count()
    assert leaks(frame([]), bench(spark, items)).count() == 0


def test_short_items_with_one_substitution(spark, frame):
    for n in range(5, 13):
        item = [f"i{k}" for k in range(n)]
        rows = [(100, " ".join(item))] + [(k, " ".join(["x", *item[:k], "other", *item[k + 1:], "y"])) for k in range(n)]
        two = [*item]
        two[0] = two[-1] = "other"
        got = {r["doc_id"]: r["agreeing"] for r in leaks(frame([*rows, (200, " ".join(two))]), bench(spark, [(1, " ".join(item))])).collect()}
        assert got == ({100: n} | ({k: n - 1 for k in range(n)} if n >= 8 else {}))


def test_leaks_on_odd_rows_and_repeated_items(spark, frame, odd_rows):
    long = next(t for i, t in odd_rows if i == 6).split()
    items = [(1, " ".join(long[30_000:30_040])), (2, " ".join(long[30_000:30_040])), (None, " ".join(long[:13])), (3, "one"), (4, None), (5, "a b c d e f g")]
    got = sorted((r["doc_id"], r["item_id"] or 0, r["agreeing"], r["word_start"]) for r in leaks(frame(odd_rows, wide=True), bench(spark, items)).collect())
    assert got == sorted([(d, i, 13, s) for d in (6, 7) for i, s in ((1, 30_000), (2, 30_000), (0, 0))] + [(d, 5, 7, 0) for d in (9, 10)])


def test_a_passage_in_a_third_of_all_documents(spark, frame):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(i, f"d{i} start {passage} end {i}" if i % 3 == 0 else f"d{i} nothing of it") for i in range(600)]
    got = leaks(frame(rows), bench(spark, [(7, passage)])).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(0, 600, 3)) and {(r["agreeing"], r["word_start"]) for r in got} == {(13, 2)}
