import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.llm.hard_negatives import Tree, hard_negatives

ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType()),
                     T.StructField("embedding", T.ArrayType(T.DoubleType()))])
CLASHING = ("rid", "vec", "leaf", "norm", "score", "other", "pair", "rank", "low", "high")
WIDE = T.StructType([*ROWS.fields, *[T.StructField(c, T.StringType()) for c in CLASHING], T.StructField("at", T.DateType())])


def brute(rows, positives=5, negatives=3):
    use = []
    for i, y, v in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            use.append((i, y, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, y, v) in enumerate(use):
        if i % 10:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w, strict=False)), j, b, z) for b, (j, z, w) in enumerate(use) if b != a)
        for s, j, _, z in [x for x in scored if x[3] == y][:positives]:
            hard = [(n, k) for n, k, _, x in scored if x != y and -50 * s <= -100 * n <= -95 * s][:negatives]
            out += [(i, j, r, k, -s, -n) for r, (n, k) in enumerate(hard, 1)]
    return sorted(out)


def check(spark, rows, wide=False, **options):
    data = [(*r, *["x"] * len(CLASHING), datetime.date(2020, 1, 1)) for r in rows] if wide else rows
    df = spark.createDataFrame(data, WIDE if wide else ROWS)
    got = hard_negatives(df, F.col("id") % 10 == 0, **options)
    out = sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert out == brute(rows)
    return out


@pytest.mark.parametrize("dim, leaf", [(2, 8), (6, 16), (6, 1000)])
def test_equals_brute_force(spark, dim, leaf):
    rng = np.random.Generator(np.random.PCG64(dim + leaf))
    centres = rng.normal(size=(5, dim))
    rows = [(i, int(rng.integers(3)), (centres[i % 5] + 0.4 * rng.normal(size=dim)).round(2).tolist()) for i in range(300)]
    assert len(check(spark, rows, leaf_rows=leaf, block_rows=20)) > 100


def test_ties_repeated_rows_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(2), [rng.choice([0.0, 0.5, 1.0]), rng.choice([0.0, 1.0])]) for i in range(60)]
    rows += rows[:12] + [(70, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (80, 1, None), (90, 0, [1.0, None]), (100, 0, [float("nan"), 1.0]),
                         (110, 1, [float("-inf"), 1.0]), (120, 0, []), (130, 1, [1.0]), (140, 0, [0.75, 0.5, 2.0]), (150, 1, [0.0, 0.0])]
    assert len(check(spark, rows, wide=True, leaf_rows=5, block_rows=4)) > 20


def test_vectors_too_long_for_exact_scores_take_no_part(spark):
    rows = [(0, 0, [1.0, 0.0]), (1, 0, [1.0, 0.1]), (2, 1, [0.9, 0.0]), (3, 1, [1e30, 0.0]), (4, 0, [1e300, 1e300])]
    got = hard_negatives(spark.createDataFrame(rows, ROWS), F.col("id") == 0).collect()
    assert [(r["positive_id"], r["negative_id"]) for r in got] == [(1, 2)]


def test_empty_tables(spark):
    assert hard_negatives(spark.createDataFrame([], ROWS), F.col("id") == 0).count() == 0
    assert hard_negatives(spark.createDataFrame([(1, 0, [1.0]), (2, 1, [1.0])], ROWS), F.col("id") == 0).count() == 0
    assert hard_negatives(spark.createDataFrame([(0, 0, [1.0])], ROWS), F.col("id") == 0).count() == 0


def test_the_tree_leaves_out_what_the_annulus_cannot_reach():
    rng = np.random.Generator(np.random.PCG64(3))
    centres = 400 * rng.normal(size=(12, 8))
    rows = np.floor(centres[rng.integers(12, size=4000)] + 10 * rng.normal(size=(4000, 8)))
    tree = Tree(8, float((rows * rows).sum(axis=1).max()))
    lifted = tree.lift(rows)
    tree.build(lifted[::8], 30)
    ranges = {}
    for at, some, apart, own in tree.descend(lifted):
        for k in range(len(some)):
            for i in range(len(tree.points[at])):
                lo, hi = ranges.get((at, i, int(own[k])), (math.inf, -math.inf))
                ranges[at, i, int(own[k])] = min(lo, apart[k, i]), max(hi, apart[k, i])
    tree.set_ranges([(*k, *v) for k, v in ranges.items()])
    leaf = tree.leaf_of(lifted)
    anchors = rows[:50]
    scores = anchors @ rows.T
    low = np.sort(scores, axis=1)[:, -40]
    high = np.sort(scores, axis=1)[:, -10]
    reached = np.zeros((50, tree.leaves), bool)
    for at, on in tree.reached(anchors, (anchors * anchors).sum(axis=1), low, high):
        reached[on, at] = True
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    for a, r in zip(*np.nonzero(inside), strict=True):
        assert reached[a, leaf[r]]
    assert reached.mean() < 0.5
