"""MinHash near-duplicate detection by a signature-coordinate inverted join.

A document's set is its distinct ``width``-word shingles. A signature holds, for each of
``coordinates`` hash functions, the smallest hash of the set; two sets agree in a coordinate
with a probability equal to their Jaccard similarity. Documents are posted under each
(coordinate, value) pair, collisions are counted, and pairs with at least ``matches`` of them
are confirmed on the full sets.

* Equal sets collapse into one class first; only one representative per class is posted.
* Prefix: a pair that agrees in ``matches`` coordinates also agrees in one of the rarest ones of
  each side, so a document is only posted under its rarest values. Values held by one class cost
  nothing, and most documents have no posting left.
* Skip: collisions are counted from a candidate pair's two signatures, so the long lists are
  never merged; and a posting list whose members are in one component already is skipped.
* Big groups: in a first round each list only yields pairs with two pivots (its smallest members
  by id and by hash), so a list of m near copies yields about m pairs. Confirmed links give
  components. In the second round the members of lists that still hold several components meet in lists of
  their rarest shingles instead (a long list of a frequent passage is never merged), and pairs
  across components that may still be similar are counted and confirmed like the others. A pair of
  a list is thus connected already, confirmed or refuted.

Results: with K = 64 coordinates and 30 matches, a pair at a similarity of exactly 0.75 is missed
with a chance below one in 10**6 (binomial tail; less above it). A link counts only when
``100 * intersection >= 100 * threshold * union`` on the full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pullscope.llm.components import components
from pullscope.llm.text import (Slice, fresh, lowered, mapped, mix, new_folder, sequence_hashes, slices, stored,
                                word_hashes)

WIDTH = 5
PERCENT = 75
COORDINATES = 64
MATCHES = 30

_RNG = np.random.Generator(np.random.PCG64(75))
_MUL = _RNG.integers(0, 2**31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _RNG.integers(0, 2**32, 1024, dtype=np.uint32)
_SUM_1, _SUM_2 = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def shingle_sets(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and their bounds.

    A row with fewer words than ``width`` has its whole sequence as one shingle; one without
    words has none.
    """
    found, hashes = word_hashes(lowered(part))
    sets, bounds = [], np.zeros(part.rows + 1, np.int64)
    windows = sequence_hashes(hashes, width)
    limits = found.bounds.tolist()
    for i in range(part.rows):
        lo, hi = limits[i], limits[i + 1]
        if hi - lo >= width:
            own = np.sort(windows[lo:hi - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own
        elif hi > lo:
            own = sequence_hashes(hashes[lo:hi], hi - lo, seed=hi - lo)
        else:
            own = hashes[:0]
        sets.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: together with its size they name the set."""
    out = []
    for salt in (_SUM_1, _SUM_2):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ salt), dtype=np.uint64)))
        out.append(sums[bounds[1:]] - sums[bounds[:-1]])
    return out[0], out[1]


def signatures(values: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """One row per set of ``coordinates`` 32-bit minima (zeros for an empty set)."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), coordinates), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        heads, high = bounds[:-1][full], (values >> np.uint64(32)).astype(np.uint32)
        for k in range(coordinates):
            mixed = high ^ _XOR[k]
            mixed *= _MUL[k]
            mixed ^= mixed >> np.uint32(15)
            mixed *= _MUL[k + 512]
            out[full, k] = np.minimum.reduceat(mixed, heads)
    return out


def _signed(width: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("doc_id")
            for part in slices(batch.column("text")):
                values, bounds = shingle_sets(part, width)
                one, two = fingerprints(values, bounds)
                sig = signatures(values, bounds, coordinates)
                raw = pa.py_buffer(np.ascontiguousarray(sig).tobytes())
                where = pa.py_buffer((np.arange(part.rows + 1, dtype=np.int32) * (4 * coordinates)).tobytes())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + part.rows)), ids[part.first:part.last].cast(pa.int64()),
                    batch.column("mark")[part.first:part.last],
                    pa.array(np.diff(bounds)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                    pa.Array.from_buffers(pa.binary(), part.rows, [None, where, raw]),
                ], names=["rid", "doc_id", "mark", "n_shingles", "fp1", "fp2", "sig"])
                rid += part.rows

    return run


def _posted(coordinates: int):
    """Postings of a class: its (coordinate, value) pairs as one 64-bit number each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, coordinates)
            tokens = (np.arange(coordinates, dtype=np.int64) << 32)[None, :] | sig.astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("rid").to_numpy(), coordinates)), pa.array(tokens.reshape(-1))],
                names=["rid", "token"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                values, bounds = shingle_sets(part, width)
                one, two = fingerprints(values, bounds)
                rids = batch.column("rid")[part.first:part.last]
                same = (one.view(np.int64) == batch.column("fp1")[part.first:part.last].to_numpy()) \
                    & (two.view(np.int64) == batch.column("fp2")[part.first:part.last].to_numpy())
                whole = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([rids, whole], names=["rid", "shingles"]).filter(pa.array(same))

    return run


def _collisions(coordinates: int):
    """Count the coordinates in which the two signatures of a pair agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, coordinates)
                    for c in ("sig_a", "sig_b"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array((a == b).sum(axis=1).astype(np.int32))],
                names=["a", "b", "matches"])

    return run


def _rarest(classes: DataFrame, coordinates: int, matches: int, folder: str) -> DataFrame:
    """``token, rid``: the prefix postings of every class, from lists with two members or more."""
    posts = stored(mapped(classes.select("rid", "sig"), _posted(coordinates), "rid long, token long"), f"{folder}/posts")
    # stored, here and below, so that the join is between plain tables and AQE can split a hot value
    shared = stored(posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), f"{folder}/shared")
    # of a class with s shared values, those held by it alone fill the prefix first
    own = (posts.join(shared, "token").groupBy("rid")
           .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
           .where(F.size("shared") >= matches)
           .select("rid", F.explode(F.expr(f"slice(shared, 1, size(shared) - {matches - 1})")).alias("s")))
    return own.select(F.col("s.token").alias("token"), "rid")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, coordinates: int, matches: int, percent: int,
               path: str) -> DataFrame:
    """The pairs (a, b) that agree in enough coordinates and whose full sets are similar."""
    sigs = classes.select("rid", "sig", "n_shingles")
    both = (pairs.join(sigs.toDF("a", "sig_a", "n_a"), "a").join(sigs.toDF("b", "sig_b", "n_b"), "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    counted = stored(mapped(both.select("a", "b", "sig_a", "sig_b"), _collisions(coordinates),
                            "a long, b long, matches int").where(F.col("matches") >= matches), f"{path}-counted")
    common = F.size(F.array_intersect("set_a", "set_b"))
    joined = (counted.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
              .select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b") - common).alias("all")))
    return stored(joined.where(F.col("common") * 100 >= F.col("all") * percent).select("a", "b"), path)


def _across(unsettled: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs (a < b) of classes with different roots that may be similar enough, by the rarest shingles.

    Shingles are ordered by their number of holders among these classes. Two sets whose similarity is
    ``percent`` or more share ``percent / (100 + percent)`` of the sum of their sizes; the first of the shared ones in
    that order stands in the prefix of both, and enough must still follow it on each side. So classes that
    have a frequent passage in common but too little else meet in no list.
    """
    held = sets.join(unsettled, "rid").select("rid", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    held = stored(held, f"{folder}/shingles")
    shared = stored(held.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"), f"{folder}/shared-shingles")
    own = Window.partitionBy("rid")
    ranked = (held.join(shared, "s").withColumn("place", F.row_number().over(own.orderBy("df", "s")))
              .withColumn("after", F.count("*").over(own) - F.col("place")))
    least = F.ceil(F.col("n") * percent / 100)
    prefix = stored(ranked.where(F.col("after") + 1 >= least).select("s", "rid", "root", "n", "after"), f"{folder}/rare")
    # lists of one root are done; in the others a pair has at least one member outside the list's most frequent root
    tops = (prefix.groupBy("s", "root").agg(F.count("*").alias("c")).groupBy("s")
            .agg(F.max_by("root", F.struct("c", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1"))
    tops = stored(tops.select("s", "top"), f"{folder}/tops")
    listed = stored(prefix.join(tops, "s"), f"{folder}/mixed-lists")
    a = listed.where("root <> top").select("s", *[F.col(c).alias(f"{c}_a") for c in ("rid", "root", "n", "after")])
    b = listed.select("s", *[F.col(c).alias(f"{c}_b") for c in ("rid", "root", "n", "after")], (F.col("root") != F.col("top")).alias("few_b"))
    enough = (F.least("after_a", "after_b") + 1) * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    once = ~F.col("few_b") | (F.col("rid_a") < F.col("rid_b"))  # two members outside it meet once
    met = a.join(b, (a["s"] == b["s"]) & (F.col("root_a") != F.col("root_b")) & once & enough)
    return stored(met.select(F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b")).distinct(), f"{folder}/across")


def near_dedup(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, coordinates: int = COORDINATES,
               matches: int = MATCHES) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept, class_size (rows with the same set), and mark
    (a hash of the text, which tells rows with one doc_id apart).

    Rows are linked when their sets' similarity is ``percent`` per cent or more; component_id is
    the smallest doc_id reachable. ``kept`` is true where doc_id equals it. A null or blank text
    has an empty set, is linked with nothing and kept. Rows with a null id take part in links; a
    component of such rows alone has a null component_id and keeps its row that was read first.
    Of rows that repeat the kept doc_id, the one read first is kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    signed = stored(mapped(docs, _signed(width, coordinates),
                           "rid long, doc_id long, mark long, n_shingles long, fp1 long, fp2 long, sig binary"), f"{folder}/signed")
    key = ["n_shingles", "fp1", "fp2"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("rid")))
    groups = stored(signed.where("n_shingles > 0").groupBy(*key).agg(first.alias("first"), F.count("*").alias("class_size"))
                    .select(*key, F.col("first.id").alias("class_id"), F.col("first.rid").alias("rid"), "class_size"),
                    f"{folder}/groups")
    classes = stored(signed.select("rid", "mark", "sig").join(groups, "rid"), f"{folder}/classes")
    posts = stored(_rarest(classes, coordinates, matches, folder), f"{folder}/prefix")
    lists = posts.groupBy("token").agg(F.count("*").alias("members"), F.min("rid").alias("low"),
                                       F.min_by("rid", F.xxhash64("token", "rid")).alias("other")).where("members > 1")
    lists = stored(lists, f"{folder}/list-heads")
    posts = stored(posts.join(lists.select("token"), "token"), f"{folder}/lists")
    needed = classes.join(posts.select("rid").distinct(), "rid").select("rid", "class_id", F.col("mark").alias("class_mark"), "fp1", "fp2")
    # by id and text hash: rows that repeat an id, or have none, meet their own text only
    own_text = docs.doc_id.eqNullSafe(needed.class_id) & (docs.mark == needed.class_mark)
    sets = docs.join(needed, own_text).select("rid", "text", "fp1", "fp2")
    sets = stored(mapped(sets, _sets(width), "rid long, shingles array<long>").dropDuplicates(["rid"]), f"{folder}/sets")

    def ordered(frame: DataFrame) -> DataFrame:
        return frame.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()

    held = posts.join(lists, "token")
    stars = ordered(held.select(F.explode(F.array("low", "other")).alias("a"), F.col("rid").alias("b")))
    links = _confirmed(stars, classes, sets, coordinates, matches, percent, f"{folder}/links-1")
    roots = components(links, f"{folder}/roots-1")
    named = stored(posts.join(roots.toDF("rid", "root"), "rid", "left")
                   .select("token", "rid", F.coalesce("root", "rid").alias("root")), f"{folder}/named")
    open_lists = named.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_lists = stored(open_lists, f"{folder}/open")
    unsettled = named.join(open_lists.select("token"), "token").select("rid", "root").distinct()
    rest = _across(unsettled, sets, percent, folder)
    more = _confirmed(rest.join(stars, ["a", "b"], "left_anti"), classes, sets, coordinates, matches, percent,
                      f"{folder}/links-2")
    nodes = roots.toDF("rid", "root")
    if not more.isEmpty():  # the links found last join whole components: only their roots are gone through again
        at_root = roots.toDF("id", "root")
        ends = (more.join(at_root.toDF("a", "root_a"), "a", "left").join(at_root.toDF("b", "root_b"), "b", "left")
                .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
        joined = components(ends, f"{folder}/roots-2").toDF("old", "new")
        every = nodes.union(ends.select(F.explode(F.array("a", "b")).alias("rid"), "rid")).distinct()
        nodes = stored(every.join(joined, every["root"] == joined["old"], "left")
                       .select("rid", F.coalesce("new", "root").alias("root")), f"{folder}/nodes")
    rooted = groups.join(nodes.toDF("rid", "root"), "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    best = F.min(F.struct(F.col("class_id").isNull().alias("none"), F.col("class_id").alias("id"), F.col("rid").alias("rid")))
    heads = rooted.groupBy("root").agg(best.alias("best")).select("root", F.col("best.id").alias("component_id"),
                                                                  F.col("best.rid").alias("kept_rid"))
    member = rooted.join(heads, "root").select(*key, "class_size", "component_id", "kept_rid")
    out = signed.drop("sig").join(member, key, "left")
    empty = F.col("n_shingles") == 0
    return out.select("doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (empty | (F.col("rid") == F.col("kept_rid"))).alias("kept"),
                      F.when(empty, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"), "mark")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates (its smallest doc_id), columns unchanged.
    Rows that agree in doc_id and text are one document; empty documents all stay."""
    one, two = fresh(docs, "id", "mark")
    kept = near_dedup(docs, **options).where("kept").select(F.col("doc_id").alias(one), F.col("mark").alias(two)).distinct()
    kept = stored(kept, new_folder(docs.sparkSession, "near-kept"))
    same = docs["doc_id"].cast("long").eqNullSafe(kept[one]) & (F.xxhash64(docs["text"]) == kept[two])
    return docs.join(kept, same).dropDuplicates([one, two]).select(*docs.columns)
