import datetime
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from pullscope.llm.embedding_dedup import near_vectors, spherical_kmeans
from pullscope.llm.vectors import matrices

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])
CLASHING = ("rid", "cell", "unit", "role", "own", "cls", "mult", "dim", "links", "root", "low", "id", "score", "leaf")
WIDE = T.StructType([*VECTORS.fields, *[T.StructField(c, T.StringType()) for c in CLASHING], T.StructField("at", T.DateType())])


def frame(spark, rows, wide=False):
    if wide:
        rows = [(*r, *["x"] * len(CLASHING), datetime.date(2020, 1, 1)) for r in rows]
    return spark.createDataFrame(rows, WIDE if wide else VECTORS)


def brute(rows, cosine=0.93):
    """(vec_id, n_links, component_id) of every row from all pairs."""
    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    vectors = [np.float32(v).astype(float) if usable(v, y) else None for _, v, y in rows]
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= cosine:
                    links[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids, default=None)))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, wide=False, **options):
    got = near_vectors(frame(spark, rows, wide), **options).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return got


def some_rows(seed, n, dim, spread, labels=3, hot=0):
    """Vectors around centres: neighbours on both sides of the threshold, in one dense group as well."""
    rng = np.random.Generator(np.random.PCG64(seed))
    centres = rng.normal(size=(max(n // 6, 1), dim))
    rows = []
    for i in range(n):
        c = centres[rng.integers(len(centres))]
        rows.append((int(1000 - i), (c + rng.normal(size=dim) * spread * rng.random()).tolist(), int(rng.integers(labels))))
    base = rng.normal(size=dim)
    rows += [(2000 + i, (base + 0.08 * rng.normal(size=dim)).tolist(), 0) for i in range(hot)]
    rng.shuffle(rows)
    return [(int(i), [float(np.float32(x)) for x in v], int(y)) for i, v, y in rows]


@pytest.mark.parametrize("dim, spread", [(3, 0.8), (16, 0.5), (64, 0.5)])
def test_links_equal_those_of_all_pairs(spark, dim, spread):
    rows = some_rows(dim, 260, dim, spread, hot=60)
    got = check(spark, rows, cell_rows=8, block_rows=16)
    assert sum(r["n_links"] for r in got) > 60 * 59 and sum(not r["kept"] for r in got) > 59


def test_one_cell_and_many_cells_agree(spark):
    rows = some_rows(9, 200, 8, 0.6, labels=1)
    assert sorted(check(spark, rows, cell_rows=10_000)) == sorted(check(spark, rows, cell_rows=4, block_rows=7))


def test_odd_rows(spark):
    v = [0.5, 0.25, -1.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0, -0.0], 1), (4, [1.0, None, 0.0], 1), (5, [1.0, float("nan"), 0.0], 1),
            (6, [float("inf"), 0.0, 0.0], 1), (7, v, None), (8, v, None), (9, v, 1), (9, v, 1), (10, [2 * x for x in v], 1), (None, v, 1),
            (None, [0.0, 0.0, 1.0], 2), (None, [0.0, 0.0, 2.0], 2), (11, v, 2), (12, v[:2], 1), (13, v[:2], 1), (14, [3e38, 3e38, -3e38], 3),
            (15, [1e-40, 1e-40, -1e-40], 3), (16, [-x for x in v], 1), (17, [1.0], 4), (18, [2.0], 4)]
    got = near_vectors(frame(spark, rows, wide=True), cell_rows=1, block_rows=2).collect()
    want = [(i, n, c) for i, n, c in brute([r for r in rows if r[0] not in (14, 15)])] + [(14, 1, 14), (15, 1, 14)]
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)
    assert sum(r["kept"] for r in got if r["vec_id"] is None) == 2


def test_equal_vectors_count_each_other(spark):
    rows = [(i, [1.0, 2.0, 3.0], 7) for i in range(5, 90)] + [(i, [3.0, -2.0, 1.0], 7) for i in range(90, 95)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in check(spark, rows, cell_rows=1, block_rows=3)}
    assert got[50] == (84, 5) and got[94] == (4, 90)


def test_a_dense_group_is_not_compared_pair_by_pair(spark):
    """2000 near copies and few others: the work is members times others, not members times members."""
    rng = np.random.Generator(np.random.PCG64(1))
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in np.float32(base + 0.05 * rng.normal(size=16))], 0) for i in range(2000)]
    rows += [(5000 + i, [float(x) for x in np.float32(rng.normal(size=16))], 0) for i in range(40)]
    got = near_vectors(frame(spark, rows), cell_rows=50).collect()
    assert all(r["n_links"] == 1999 and r["component_id"] == 0 for r in got if r["vec_id"] < 2000)
    vectors = np.array([r[1] for r in rows])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    centres = spherical_kmeans(vectors, 40)
    group = vectors[:2000] @ centres.T
    assert len(set(group.argmax(axis=1).tolist())) == 1  # one cell holds the group
    assert (group.max(axis=1) >= math.cos(math.acos(0.93) / 2)).mean() > 0.99  # and nearly all of it is its core


def test_empty_table(spark):
    assert near_vectors(frame(spark, [])).count() == 0


def test_matrices_reads_sliced_lists():
    import pyarrow as pa
    column = pa.array([[9.0], [1.0, 2.0], None, [3.0, None], [], [4.0, 5.0]], pa.list_(pa.float32())).slice(1)
    got = {rows.shape[1]: (at.tolist(), rows.tolist()) for at, rows in matrices(column)}
    assert got[0] == ([3], [[]]) and got[2][0] == [0, 2, 4] and got[2][1][2] == [4.0, 5.0] and math.isnan(got[2][1][1][1])
