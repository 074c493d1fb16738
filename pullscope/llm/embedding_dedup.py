"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Vectors are compared within equal labels (and equal lengths). Every label's vectors are cut into cells by
spherical k-means, fitted on a bounded sample; every vector is assigned to its nearest centroid's cell and
compared with the cell's other vectors by blocks of cosine products. One vector of each group of linked
vectors is kept.

No link is lost at a cell's border. Between the centroids c and c' the border is a plane, and two unit
vectors with a cosine of t are ``sqrt(2 - 2t)`` apart, so of a linked pair that the plane separates one
vector lies within half that distance of it. Every vector is therefore also a guest of the cells whose
border is that near; guests are compared with the cell's own vectors only. A pair that meets in two
cells counts in the cell with the smaller number.

Scale: equal vectors are one class with a count before anything else, by a map-side aggregate. A cell's
vectors within half the angle of the threshold of its centroid (its core) are all linked to each other by
the triangle inequality: they are counted, not compared, so a group of near copies that holds a third of
all rows costs its members times the vectors around it. Centroids closer than the threshold are merged, so
that such a group is not cut into many cells that would all be each other's guests. All other products
run in groups of two blocks of at most about 1024 rows. What leaves a group is one row per linked vector
(its count and the group's local root), never a pair. The centroids of all labels together are at most
``most_cells``; beyond that cells grow and take more blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.components import components
from pullscope.llm.text import mapped, new_folder, ship, stored
from pullscope.llm.vectors import block_product, matrices, packed, unpacked

#: Least cosine of a link.
COSINE = 0.93
#: Wanted vectors of a cell; labels with fewer than twice as many are one cell.
CELL_ROWS = 1024
#: Most centroids of a label, and of all labels together (they are broadcast: 8 MB at 64 components).
LABEL_CELLS = 1024
MOST_CELLS = 16384
#: Sampled vectors for each centroid, and rounds of the fit.
PER_CENTROID = 32
ROUNDS = 8
#: For rounding: far more than the error of a cosine, far less than any margin that matters.
TINY = 1e-9

_CELL = ["label", "dim", "cell"]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors; none for vectors that are null, zero or hold null or non-finite components."""
    rid = (TaskContext.get().partitionId() << 40) - 1
    for batch in batches:
        n = batch.num_rows
        unit: list[bytes | None] = [None] * n
        dim = np.zeros(n, np.int32)
        for at, rows in matrices(batch.column("embedding")):
            if not rows.shape[1]:
                continue
            most = np.abs(rows).max(axis=1)
            good = np.isfinite(most) & (most > 0)
            at, rows = at[good], rows[good] / most[good, None]
            rows /= np.sqrt((rows * rows).sum(axis=1))[:, None]
            for i, cell in zip(at, packed(rows + 0.0), strict=True):
                unit[i] = cell
            dim[at] = rows.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rid + 1, rid + 1 + n)), batch.column("vec_id"), batch.column("label"), pa.array(dim),
             pa.array(unit, pa.binary())], names=["rid", "vec_id", "label", "dim", "unit"])
        rid += n


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = ROUNDS, merge: float = COSINE, seed: int = 11) -> np.ndarray:
    """At most ``k`` unit centroids of unit vectors; of two closer than ``merge`` the one with fewer rows goes."""
    rng = np.random.Generator(np.random.PCG64(seed))
    centres = rows[np.sort(rng.choice(len(rows), min(k, len(rows)), replace=False))]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        lengths = np.sqrt((sums * sums).sum(axis=1))
        some = lengths > TINY
        centres = np.where(some[:, None], sums / np.where(some, lengths, 1)[:, None], centres)
    counts = np.bincount((rows @ centres.T).argmax(axis=1), minlength=len(centres))
    kept: list[int] = []
    near = centres @ centres.T
    for i in np.argsort(-counts, kind="stable"):
        if not kept or near[i, kept].max() < merge:
            kept.append(i)
    return centres[sorted(kept)]


def _fit(merge: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("unit")
        centres = spherical_kmeans(unpacked(table["unit"]), table["cells"][0].as_py(), merge=merge)
        n = len(centres)
        return pa.table({"label": pa.concat_arrays([table["label"].combine_chunks()[:1]] * n),
                         "dim": pa.array([table["dim"][0].as_py()] * n, pa.int32()),
                         "cell": pa.array(range(n), pa.int32()), "centre": pa.array(packed(centres), pa.binary())})

    return run


def _assign(centres: dict, half: float, core: float):
    """Rows of classes with their cell and role: 0 core, 1 other own vector, 2 guest (with its own cell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            of: dict = {}
            for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                of.setdefault(key, []).append(i)
            for key, members in of.items():
                if key in centres and key not in known:
                    c = centres[key]
                    apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) if len(c) <= 256 else np.sqrt(
                        np.maximum(2 - 2 * (c @ c.T), 0))
                    known[key] = c, np.maximum(apart, TINY)
                for first in range(0, len(members), 1024):
                    some = batch.take(pa.array(members[first:first + 1024]))
                    n = some.num_rows
                    if key not in centres:
                        cell, role, src = np.zeros(n, np.int32), np.ones(n, np.int8), np.arange(n)
                        own, guests = cell, [[]] * n
                    else:
                        c, apart = known[key]
                        dots = unpacked(some.column("unit")) @ c.T
                        own = dots.argmax(axis=1).astype(np.int32)
                        best = dots[np.arange(n), own]
                        near = (best[:, None] - dots) <= (half + TINY) * apart[own]
                        near[np.arange(n), own] = False
                        at, cells = np.nonzero(near)
                        cuts = np.searchsorted(at, np.arange(n + 1))
                        guests = [cells[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] + [[]] * len(at)
                        src = np.concatenate([np.arange(n), at])
                        role = np.concatenate([(best < core + TINY).astype(np.int8), np.full(len(at), 2, np.int8)])
                        cell = np.concatenate([own, cells.astype(np.int32)])
                        own = own[src]
                    part = some.take(pa.array(src))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("label"), part.column("dim"), pa.array(cell), pa.array(role), pa.array(own),
                         pa.array(guests, pa.list_(pa.int32())), part.column("cls"), part.column("mult"), part.column("unit")],
                        names=["label", "dim", "cell", "role", "own", "guests", "cls", "mult", "unit"])

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(cosine: float):
    """Links between a block of a cell's guests and non-core vectors and a block of its own vectors."""

    def run(key: tuple, probes: pa.Table, own: pa.Table) -> pa.Table:
        cell = key[2].as_py()
        p, b = np.nonzero(unpacked(probes["unit"], 1) @ unpacked(own["unit"], 1).T >= cosine) if len(probes) and len(own) else 2 * (
            np.zeros(0, np.int64),)
        ids_p, ids_b = probes["cls"].to_numpy(), own["cls"].to_numpy()
        role_p, role_b = probes["role"].to_numpy(), own["role"].to_numpy()
        home = probes["own"].to_numpy().astype(np.int64)
        lists = own["guests"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy()) if len(own) else np.zeros(0, np.int64)
        width = 1 << 32
        also = np.repeat(np.arange(len(own)), lengths) * width + lists.flatten().to_numpy() if lengths.sum() else np.zeros(0, np.int64)
        twice = (home[p] < cell) & np.isin(b * width + home[p], also)
        good = np.where(role_p[p] == 2, ~twice, (role_b[b] == 0) | (ids_p[p] < ids_b[b]))
        p, b = p[good], b[good]
        ids, place = np.unique(np.concatenate([ids_p[p], ids_b[b]]), return_inverse=True)
        a, c = place[:len(p)], place[len(p):]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, a, own["mult"].to_numpy()[b])
        np.add.at(links, c, probes["mult"].to_numpy()[p])
        return pa.table({"cls": pa.array(ids, pa.int64()), "links": pa.array(links),
                         "root": pa.array(ids[_roots(len(ids), a, c)], pa.int64())})

    return run


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS, most_cells: int = MOST_CELLS,
                 block_rows: int = 1024) -> DataFrame:
    """Per input row: vec_id, n_links (other rows linked directly), component_id (the smallest vec_id
    reachable over links, itself included) and kept (vec_id = component_id).

    Rows are linked if their labels are equal and not null and the cosine of their vectors, in double
    precision, is at least ``cosine`` (above 0). Vectors that are null, empty, zero or hold null or
    non-finite components, and vectors of different lengths, are not linked; such rows are their own
    component. Repeated rows are rows like others (linked with each other; with one vec_id all of them are
    kept). A null vec_id never names a component of rows with ids; a group without any id has a null
    component_id and keeps its rows. Only the columns vec_id, embedding and label are looked at. An empty
    table gives an empty table.
    """
    spark = embeddings.sparkSession
    ship(spark)
    folder = new_folder(spark, "vectors")
    kind = embeddings.schema["label"].dataType.simpleString()
    chord = math.sqrt(2 - 2 * cosine)
    rows = stored(mapped(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"), _units,
                         f"rid long, vec_id long, label {kind}, dim int, unit binary"), f"{folder}/rows")
    able = rows.where("unit is not null and label is not null")
    classes = stored(able.groupBy("label", "dim", "unit")
                     .agg(F.min("rid").alias("cls"), F.min("vec_id").alias("low"), F.count("*").alias("mult")), f"{folder}/classes")

    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    wanted = max(cell_rows, math.ceil(total / most_cells))
    cells = (sizes.withColumn("cells", F.least((F.col("n") / wanted).cast("int"), F.lit(LABEL_CELLS))).where("cells > 1")
             .withColumn("share", F.col("cells") * PER_CENTROID / F.col("n")))
    sample = (classes.join(cells, ["label", "dim"])
              .where(F.pmod(F.xxhash64(F.lit(7), "unit"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
              .select("label", "dim", "cells", "unit"))
    fitted = (sample.groupBy("label", "dim").applyInArrow(_fit(cosine), f"label {kind}, dim int, cell int, centre binary")
              .orderBy("label", "dim", "cell").collect())
    lists: dict = {}
    for r in fitted:
        lists.setdefault((r["label"], r["dim"]), []).append(np.frombuffer(r["centre"], np.float64))
    centres = {k: np.array(v) for k, v in lists.items()}

    angle = math.acos(cosine) / 2
    placed = stored(mapped(classes.drop("low"), _assign(centres, chord / 2, math.cos(angle)),
                           f"label {kind}, dim int, cell int, role byte, own int, guests array<int>, cls long, mult long, unit binary"),
                    f"{folder}/placed")
    met = block_product(placed.where("role > 0").select(*_CELL, "role", "own", "cls", "mult", "unit"),
                        placed.where("role < 2").select(*_CELL, "role", "guests", "cls", "mult", "unit"),
                        _CELL, "cls", _links(cosine), "cls long, links long, root long", block_rows)
    core = placed.where("role = 0").select(*_CELL, "cls", "mult")
    hubs = stored(core.groupBy(*_CELL).agg(F.sum("mult").alias("all"), F.min("cls").alias("root")), f"{folder}/hubs")
    cored = core.join(hubs, _CELL).select("cls", (F.col("all") - F.col("mult")).alias("links"), "root")
    found = stored(met.unionByName(cored), f"{folder}/found")

    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")), folder)
    joined = stored(classes.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
                    .select("label", "dim", "unit", "low", "mult", F.coalesce("root", "cls").alias("root"),
                            (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links")), f"{folder}/joined")
    lowest = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    done = stored(joined.join(lowest, "root").select("label", "dim", "unit", "n_links", "component_id"), f"{folder}/done")
    linked = able.join(done, ["label", "dim", "unit"]).select("vec_id", "n_links", "component_id")
    alone = (rows.where("unit is null or label is null")
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
