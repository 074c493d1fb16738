"""Ordered lists: rows of rare keys are dealt once, those of hot keys by ranges; both give the same pages."""

import random
import re

from pullscope.operators import bridges
from pullscope.operators.bridges import ordered_lists


def test_rare_keys_are_dealt_once(spark):
    df = spark.range(5000).selectExpr("cast(id % 1700 as string) sha", "id * 7919 % 5000 pr_id")
    lists = ordered_lists(df, "sha", ["pr_id"], "pr_id", page_rows=2)
    plan = lists._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert len(re.findall(r"Exchange (?:hash|range|Round)", plan)) == 1
    want = {}
    for r in df.orderBy("pr_id").collect():
        want.setdefault(r["sha"], []).append(r["pr_id"])
    got = {(r["sha"], r["page"]): r["items"] for r in lists.collect()}
    assert got == {(k, i // 2): v[i:i + 2] for k, v in want.items() for i in range(0, len(v), 2)}


def test_hot_and_rare_keys_give_the_same_pages(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 5 + [None, "b"] + [f"k{i}" for i in range(30)]), rng.randrange(40), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "sha string, seq int, pr_id long").repartition(5)
    placed, ranged = bridges.ordered_places, []
    monkeypatch.setattr(bridges, "ordered_places", lambda d, *a: (ranged.append({r["sha"] for r in d.select("sha").distinct().collect()}), placed(d, *a))[1])
    key = lambda r: (r["sha"] or "", r["page"])
    want, got, every = (sorted(ordered_lists(df, "sha", ["seq", "pr_id"], "pr_id", page_rows=64, hot_rows=n).collect(), key=key)
                        for n in (10_000, 300, 0))
    assert want == got == every
    assert len(ranged) == 2 and "hot" in ranged[0] and ranged[0] < ranged[1] == {r[0] for r in rows}
