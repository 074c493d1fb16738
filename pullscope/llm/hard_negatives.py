"""Hard negatives for contrastive training, mined with a multiway hyperplane tree (GNAT style).

A row's score for an anchor is the integer inner product of their vectors (components floor(scale * x)).
Inner products become distances: every row gets one more component, ``sqrt(R^2 - |x|^2)`` with R the
longest row's length, and the anchor a zero, so ``d^2 = |a|^2 + R^2 - 2 * score``. A window of scores is
then an annulus of distances around the anchor.

The tree: each inner node has up to ``BRANCHES`` split points, and a row goes down to the nearest one. For
every pair of split points (i, j) of a node the least and largest distance from i to any row below j is
stored. A search at a node takes its distances to the split points; subtree j can only hold distances
``max_i(d_i - most_ij, least_ij - d_i) .. min_i(d_i + most_ij)``, and is left out if that range misses
the annulus. Leaves are scanned exactly. Split points come from a bounded sample; all rows are put into
leaves and all count in the stored ranges, so every search is exact.

Searches run for all anchors at once: first every anchor scans the leaves beside the one it would fall into, which
bounds its worst positive; then all leaves that the annulus above that bound reaches. The positives' scores
give the windows of the negatives, which are searched the same way. Neighbouring leaves form pages of
``PAGE``. (anchor, page) visits, which name the leaves, and the pages' rows meet in groups of two bounded blocks
(``block_product``); a group returns its best few per anchor, and windows with a rank limit, which Spark applies
before the shuffle, keep the best of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pullscope.llm.text import mapped, new_folder, stored
from pullscope.llm.vectors import block_product, matrices, packed, unpacked

#: Split points of a node.
BRANCHES = 8
#: Wanted rows of a leaf.
LEAF_ROWS = 1024
#: Neighbouring leaves whose rows are scanned together.
PAGE = 8
#: Anchors scored at once.
ANCHORS = 64
#: Most sampled rows, of which about 16 stand for a leaf; the tree has at most about 4096 leaves.
SAMPLE_ROWS = 65536
PER_LEAF = 16
#: Squared lengths below this bound have exact inner products in double precision.
EXACT = float(1 << 53)


def _scaled(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = (TaskContext.get().partitionId() << 40) - 1
        for batch in batches:
            n = batch.num_rows
            vec: list[bytes | None] = [None] * n
            dim, norm = np.zeros(n, np.int32), np.zeros(n)
            for at, rows in matrices(batch.column("embedding")):
                with np.errstate(over="ignore", invalid="ignore"):
                    rows = np.floor(rows * scale)
                    square = (rows * rows).sum(axis=1)
                good = np.isfinite(square) & (square < EXACT)
                for i, cell in zip(at[good], packed(rows[good] + 0.0), strict=True):
                    vec[i] = cell
                dim[at], norm[at] = rows.shape[1], np.where(good, square, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rid + 1, rid + 1 + n)), batch.column("id"), batch.column("label"), pa.array(dim),
                 pa.array(norm.astype(np.int64)), pa.array(vec, pa.binary())], names=["rid", "id", "label", "dim", "norm", "vec"])
            rid += n

    return run


def _padded(cells: list[bytes], dim: int) -> np.ndarray:
    """Packed rows as a matrix of ``dim`` components; shorter rows end in zeros."""
    if all(len(c) == 8 * dim for c in cells):
        return np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), dim)
    return np.frombuffer(b"".join(c.ljust(8 * dim, b"\0") for c in cells), np.float64).reshape(len(cells), dim)


class Tree:
    """Split points by node. ``below[node]`` has the child of each: a node, or ``-1 - leaf``."""

    def __init__(self, dim: int, radius2: float):
        self.dim, self.radius2 = dim, radius2
        self.points: list[np.ndarray] = []
        self.below: list[np.ndarray] = []
        self.leaves = 0
        self.least: list[np.ndarray] = []
        self.most: list[np.ndarray] = []

    def lift(self, rows: np.ndarray) -> np.ndarray:
        square = (rows * rows).sum(axis=1)
        return np.hstack([rows, np.sqrt(np.maximum(self.radius2 - square, 0))[:, None]])

    def build(self, rows: np.ndarray, leaf_rows: float, seed: int = 5) -> Tree:
        """Split points from lifted sample rows, until a leaf has at most ``leaf_rows`` of them."""
        rng = np.random.Generator(np.random.PCG64(seed))

        def node(rows: np.ndarray) -> int:
            distinct = len(rows) > leaf_rows and np.unique(rows, axis=0)
            if len(rows) <= leaf_rows or len(distinct) < 2:
                self.leaves += 1
                return -self.leaves
            # candidates far from each other, chosen greedily
            some = distinct[np.sort(rng.choice(len(distinct), min(len(distinct), 4 * BRANCHES), replace=False))]
            chosen = [0]
            far = ((some - some[0]) ** 2).sum(axis=1)
            while len(chosen) < min(BRANCHES, len(some)):
                chosen.append(int(far.argmax()))
                far = np.minimum(far, ((some - some[chosen[-1]]) ** 2).sum(axis=1))
            points = some[chosen]
            own = self.distances(rows, points).argmin(axis=1)
            at = len(self.points)
            self.points.append(points)
            self.below.append(np.zeros(len(points), np.int64))
            for j in range(len(points)):
                part = rows[own == j]
                self.below[at][j] = node(part) if len(part) < len(rows) else self._leaf()
            return at

        node(rows)
        return self

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def distances(self, rows: np.ndarray, points: np.ndarray, square: float | np.ndarray | None = None) -> np.ndarray:
        own = self.radius2 if square is None else square[:, None]
        return np.sqrt(np.maximum(own + self.radius2 - 2 * (rows @ points.T), 0))

    def descend(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Every node that rows pass: (node, rows, their distances to its split points, nearest one)."""
        todo = [(0, np.arange(len(rows)))] if self.points else []
        while todo:
            at, some = todo.pop()
            apart = self.distances(rows[some], self.points[at])
            own = apart.argmin(axis=1)
            yield at, some, apart, own
            todo += [(int(c), some[own == j]) for j, c in enumerate(self.below[at]) if c >= 0 and (own == j).any()]

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        for at, some, _, own in self.descend(rows):
            child = self.below[at][own]
            out[some[child < 0]] = -1 - child[child < 0]
        return out

    def set_ranges(self, rows: list) -> None:
        self.least = [np.full((len(p), len(p)), np.inf) for p in self.points]
        self.most = [np.full((len(p), len(p)), -np.inf) for p in self.points]
        for node, i, j, low, high in rows:
            self.least[node][i, j], self.most[node][i, j] = low, high

    def reached(self, anchors: np.ndarray, square: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors) of every leaf that can hold a score in an anchor's window ``low .. high``."""
        flat = np.hstack([anchors, np.zeros((len(anchors), 1))])
        # distances of the annulus, a little wider than rounding can make it
        slack = 1e-6 * (math.sqrt(self.radius2) + np.sqrt(square)) + 1e-6
        near = np.sqrt(np.maximum(square + self.radius2 - 2 * high, 0)) - slack
        far = np.sqrt(np.maximum(square + self.radius2 - 2 * low, 0)) + slack
        todo = [(0, np.flatnonzero(low <= high))]
        if not self.points:
            yield 0, todo.pop()[1]
        while todo:
            at, some = todo.pop()
            d = self.distances(flat[some], self.points[at], square[some])
            least, most = self.least[at], self.most[at]
            for j, child in enumerate(self.below[at]):
                if not np.isfinite(least[0, j]):  # no row went there
                    continue
                inner = np.maximum(d - most[:, j], least[:, j] - d).max(axis=1)
                outer = (d + most[:, j]).min(axis=1)
                on = some[(inner <= far[some]) & (outer >= near[some])]
                if len(on):
                    if child < 0:
                        yield int(-1 - child), on
                    else:
                        todo.append((int(child), on))


def _put(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                leaf = tree.leaf_of(tree.lift(_padded(part.column("vec").to_pylist(), tree.dim)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf)], names=[*part.schema.names, "leaf"])

    return run


def _ranges(tree: Tree):
    """Least and largest distance from every split point to a task's rows below each sibling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = {}
        most = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                rows = tree.lift(_padded(batch.slice(first, 4096).column("vec").to_pylist(), tree.dim))
                for at, _, apart, own in tree.descend(rows):
                    if at not in least:
                        m = len(tree.points[at])
                        least[at], most[at] = np.full((m, m), np.inf), np.full((m, m), -np.inf)
                    for j in np.unique(own):
                        own_j = apart[own == j]
                        least[at][:, j] = np.minimum(least[at][:, j], own_j.min(axis=0))
                        most[at][:, j] = np.maximum(most[at][:, j], own_j.max(axis=0))
        out = [(at, int(i), int(j), float(least[at][i, j]), float(most[at][i, j])) for at in least
               for i, j in zip(*np.nonzero(np.isfinite(least[at])), strict=True)]
        for first in range(0, len(out), 10000):
            cols = list(zip(*out[first:first + 10000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()), strict=True)],
                                             names=["node", "i", "j", "low", "high"])

    return run


def _visit(tree: Tree):
    """A row for each page that an anchor's window reaches; ``leaves`` has a bit for each leaf of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                rows = _padded(part.column("vec").to_pylist(), tree.dim)
                square = (rows * rows).sum(axis=1)
                low, high = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("reach_low", "reach_high"))
                bits: dict[int, np.ndarray] = {}
                for leaf, on in tree.reached(rows, square, low, high):
                    bits.setdefault(leaf // PAGE, np.zeros(len(rows), np.int64))[on] |= 1 << leaf % PAGE
                for page, leaves in bits.items():
                    on = np.flatnonzero(leaves)
                    some = part.take(pa.array(on))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.full(len(on), page, np.int64)), pa.array(leaves[on])],
                                                     names=[*some.schema.names, "page", "leaves"])

    return run


def _codes(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    both = pa.chunked_array([*left["label"].chunks, *right["label"].chunks], type=left.schema.field("label").type)
    codes = both.combine_chunks().dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    return codes[:len(left)], codes[len(left):]


def _best(scores: np.ndarray, good: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the ``k`` best good scores of each row, and all that tie with the last."""
    held = np.where(good, scores, -np.inf)
    if held.shape[1] > k:
        worst = np.partition(held, -k, axis=1)[:, -k]
        good = good & (held >= worst[:, None])
    return np.nonzero(good)


def _scores(visits: pa.Table, rows: pa.Table, dim: int) -> Iterator[tuple]:
    """For some visits at a time: (visits, columns of the rows in their leaves, scores, whether labels are equal)."""
    rows = rows.sort_by([("id", "ascending"), ("rid", "ascending")])
    mine, theirs = _codes(visits, rows)
    right = _padded(rows["vec"].to_pylist(), dim)
    ids, rids, leaf = rows["id"].to_numpy(), rows["rid"].to_numpy(), rows["leaf"].to_numpy()
    leaves = visits["leaves"].to_numpy()
    for first in range(0, len(visits), ANCHORS):
        part = visits.slice(first, ANCHORS)
        inside = np.flatnonzero((np.bitwise_or.reduce(leaves[first:first + ANCHORS]) >> leaf % PAGE) & 1)
        scores = _padded(part["vec"].to_pylist(), dim) @ right[inside].T
        yield part, ids[inside], rids[inside], scores, mine[first:first + ANCHORS, None] == theirs[inside]


def _positives(dim: int, k: int):
    def run(key: tuple, visits: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for part, ids, rids, scores, same in _scores(visits, rows, dim) if len(visits) and len(rows) else ():
            own = part["rid"].to_numpy()
            good = same & (own[:, None] != rids) & (scores >= part["reach_low"].to_numpy()[:, None])
            a, b = _top(*_best(scores, good, k), scores, k)
            out.append((own[a], rids[b], ids[b], scores[a, b]))
        return _table(out, "rid", "pos_rid")

    return run


def _negatives(dim: int, k: int):
    def run(key: tuple, visits: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for part, ids, rids, scores, same in _scores(visits, rows, dim) if len(visits) and len(rows) else ():
            windows = part["windows"].combine_chunks()
            of = np.repeat(np.arange(len(part)), np.diff(windows.offsets.to_numpy()))
            pair, low, high = (windows.flatten().field(c).to_numpy() for c in ("pair", "low", "high"))
            wide = scores[of]
            good = ~same[of] & (wide >= low[:, None]) & (wide <= high[:, None])
            a, b = _top(*_best(wide, good, k), wide, k)
            out.append((pair[a], rids[b], ids[b], wide[a, b]))
        return _table(out, "pair", "neg_rid")

    return run


def _top(a: np.ndarray, b: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of places sorted by row and by column, the first ``k`` of each row by score, ties by column."""
    order = np.lexsort((b, -scores[a, b], a))
    a, b = a[order], b[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return a[keep], b[keep]


def _table(parts: list, key: str, rid: str) -> pa.Table:
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)] or [np.zeros(0)] * 4
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip((key, rid, "other", "score"), cols, strict=True)})


def _first(df: DataFrame, by: str, rid: str, k: int) -> DataFrame:
    """The first ``k`` rows of every ``by`` with their rank."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), "other", rid)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, share_low: int = 50,
                   share_high: int = 95, scale: float = 256, leaf_rows: int = LEAF_ROWS, block_rows: int = 1024) -> DataFrame:
    """For the rows (id, label, embedding) that ``anchor`` (a condition on id) names: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``positives`` best other rows of its label. A positive's negatives are the
    first ``negatives`` rows of other labels with ``share_low * positive_score <= 100 * negative_score <=
    share_high * positive_score``. Higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part, nor do rows whose
    scaled vector has a squared length of 2^53 or more (their scores would not be exact). A shorter vector
    counts as if it ended in zeros, an empty one as zeros. Repeated rows are different rows: a row's copy is
    one of its positives, and a repeated anchor has its results once per row. Further columns are not looked at. An
    empty table, or one without anchors, gives an empty table.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "negatives")
    kind = rows.schema["label"].dataType.simpleString()
    table = f"rid long, id long, label {kind}, dim int, norm long, vec binary"
    able = stored(mapped(rows.select(F.col("id").cast("long").alias("id"), "label", "embedding"), _scaled(scale), table)
                  .where("id is not null and label is not null and vec is not null"), f"{folder}/rows")
    n, dim, radius2 = able.agg(F.count("*"), F.max("dim"), F.max("norm")).first()

    # the tree's split points, from a bounded sample
    tree = Tree(dim or 0, float(radius2 or 0))
    wanted = max(leaf_rows, math.ceil((n or 0) * PER_LEAF / SAMPLE_ROWS))
    if n > wanted:
        share = min(1.0, n * PER_LEAF / wanted / n)
        sample = able.where(F.pmod(F.xxhash64(F.lit(3), "rid"), F.lit(1 << 30)) < share * (1 << 30)).select("vec").toPandas()
        cells = sorted(sample["vec"])
        if cells:
            tree.build(tree.lift(_padded([bytes(c) for c in cells], tree.dim)), wanted * share)
    put = stored(mapped(able, _put(tree), f"{table}, leaf long"), f"{folder}/put")
    ranges = (mapped(put.select("vec"), _ranges(tree), "node int, i int, j int, low double, high double")
              .groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect())
    tree.set_ranges([tuple(r) for r in ranges])

    by_page = F.expr(f"leaf div {PAGE}")
    paged = put.select(by_page.alias("page"), "leaf", "rid", "id", "label", "vec")
    anchors = stored(put.where(anchor).select("rid", "id", "label", "vec", by_page.alias("home")), f"{folder}/anchors")
    found = "rid long, pos_rid long, other long, score long"

    def scanned(visits: DataFrame, function, schema: str) -> DataFrame:
        return block_product(visits, paged, ["page"], "rid", function, schema, block_rows, PAGE * block_rows)

    # positives: the home page first, then whatever may beat the worst found there
    lowest, highest = F.lit(float("-inf")), F.lit(float("inf"))
    home = anchors.select(F.col("home").alias("page"), "rid", "label", "vec", lowest.alias("reach_low"), F.lit(2**PAGE - 1).alias("leaves"))
    at_home = stored(_first(scanned(home, _positives(tree.dim, positives), found), "rid", "pos_rid", positives), f"{folder}/home")
    bound = at_home.where(F.col("rank") == positives).select("rid", F.col("score").cast("double").alias("least"))
    wide = (anchors.join(bound, "rid", "left")
            .select("rid", "label", "vec", "home", F.coalesce("least", lowest).alias("reach_low"), highest.alias("reach_high")))
    visits = stored(mapped(wide, _visit(tree), f"rid long, label {kind}, vec binary, home long, reach_low double, reach_high double, "
                                               "page long, leaves long").where("page <> home"), f"{folder}/visits")

    def floor_share(share: int) -> Column:
        """floor(score * share / 100) in whole numbers."""
        return F.expr(f"(score * {share} - pmod(score * {share}, 100)) div 100")

    elsewhere = scanned(visits.select("page", "rid", "label", "vec", "reach_low", "leaves"), _positives(tree.dim, positives), found)
    best = stored(_first(at_home.drop("rank").unionByName(elsewhere), "rid", "pos_rid", positives)
                  .select("rid", "pos_rid", "other", "score", floor_share(-share_low).alias("low"), floor_share(share_high).alias("high"))
                  .select("rid", "pos_rid", "other", "score", (-F.col("low")).alias("low"), "high",
                          F.monotonically_increasing_id().alias("pair")), f"{folder}/positives")

    # negatives: all leaves that the windows of an anchor's positives reach
    window = F.struct("pair", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))
    windows = (best.where("low <= high").groupBy("rid")
               .agg(F.collect_list(window).alias("windows"), F.min("low").cast("double").alias("reach_low"),
                    F.max("high").cast("double").alias("reach_high")))
    asked = anchors.join(windows, "rid").select("rid", "label", "vec", "windows", "reach_low", "reach_high")
    visits = stored(mapped(asked, _visit(tree), f"rid long, label {kind}, vec binary, windows array<struct<pair:bigint,low:double,high:double>>, "
                                                "reach_low double, reach_high double, page long, leaves long"), f"{folder}/negative-visits")
    hard = _first(scanned(visits.select("page", "rid", "label", "vec", "windows", "leaves"), _negatives(tree.dim, negatives),
                          "pair long, neg_rid long, other long, score long"), "pair", "neg_rid", negatives)
    named = best.join(anchors.select("rid", F.col("id").alias("anchor_id")), "rid")
    return (hard.select("pair", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(named.select("pair", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "pair")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
