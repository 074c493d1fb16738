"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length in words. A source whose target is r times its
size plus a rest takes every document r times, and the rest is fitted from the length counts
alone by a bounded-knapsack dynamic programme that finds the sum that comes nearest, from below or above. It runs
over the whole rest where that has at most ``WINDOW`` words; of a larger one each length gives its proportional share less
a few documents first, lengths with the largest remainders give more, and the programme fits the last ``WINDOW`` words. Which documents of a length are
taken is decided by a seeded hash, so reruns agree.

Scale: text is read once, for its length; everything else works on a slim table. Only length
counts (one row per source and distinct length) meet in one task per source. Lengths held by
very many documents are ranked by hash cells of bounded size: whole cells are taken by their
counts, and only the one cell that holds the cut is sorted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pullscope.llm.text import fresh, new_folder, ship, stored, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 9
#: Words of the budget that the dynamic programme fits.
WINDOW = 1 << 16
#: Documents of each length that proportional shares leave to the dynamic programme.
SPARE = 8
#: Documents in a hash cell, about.
CELL_ROWS = 100_000


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source, source_size`` (one row per source) with ``target`` added.

    Sources in code point order, null last, get ``weights`` in turn and share the sum of all
    sizes. Targets above ``most`` times their size stop there and the excess is reshared by
    weight: that ends at target = least(most * size, level * weight) with one common level, which
    is found from running sums over the sources in order of most * size / weight. The table has
    one row per source, so its windows are small.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    limit = (F.col("source_size") * most).cast("double")
    t = totals.withColumn("weight", weight).withColumn("limit", limit)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    t = t.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("place", "level"))
    t = t.withColumn("level", F.min(fits).over(everything)["level"])
    return t.select("source", "source_size",
                    F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit")).alias("target"))


def fit(lengths: list[int], counts: list[int], budget: int, window: int = WINDOW) -> list[int]:
    """How many documents of each length to take so that their words come nearest to ``budget`` (of two sums
    equally near the smaller).

    A budget of at most ``window`` is fitted over all documents, so no set of documents comes nearer. Of a larger
    one, proportional shares less ``SPARE`` documents of each length are taken first, and the rest, up to ``window``
    words, is fitted with all documents that are left.
    """
    total = sum(a * b for a, b in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    if budget <= 0:
        return [0] * len(lengths)
    take, left = [0] * len(lengths), budget
    if budget > window:
        take = [max(0, c * budget // total - SPARE) for c in counts]
        left = budget - sum(a * b for a, b in zip(lengths, take, strict=True))
        order = sorted(range(len(lengths)), key=lambda i: (-(counts[i] * budget % total), -lengths[i]))
        moved = True
        while left > window and moved:
            moved = False
            for i in order:
                if window < left >= lengths[i] > 0 and take[i] < counts[i]:
                    take[i] += 1
                    left -= lengths[i]
                    moved = True
    # sums up to the first one that any document makes past the rest
    longest = max((a for a, c, t in zip(lengths, counts, take, strict=True) if t < c), default=0)
    reach = np.zeros(left + min(longest, 2 * left + 1) + 1, bool)
    reach[0] = True
    first = np.full(len(reach), -1, np.int64)
    items: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        spare, size = counts[i] - take[i], lengths[i]
        if size <= 0 or size >= len(reach):
            continue
        spare, step = min(spare, (len(reach) - 1) // size), 1
        while spare > 0 and not reach[left]:
            k = min(step, spare)
            shift = k * size
            new = np.flatnonzero(reach[:-shift] & ~reach[shift:]) + shift
            reach[new] = True
            first[new] = len(items)
            items.append((i, k))
            spare, step = spare - k, step * 2
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at > 0:
        i, k = items[first[at]]
        take[i] += k
        at -= k * lengths[i]
    return take


def _fit_source(window: int, most: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size")
        total, budget = int(rows.source_size.iloc[0]), int(round(rows.target.iloc[0]))
        repeats = min(budget // total, most) if total else 1
        extra = fit(rows["size"].tolist(), rows.n.tolist(), budget - repeats * total, window) \
            if repeats < most and total else [0] * len(rows)
        return pd.DataFrame({"key": rows.key, "size": rows["size"], "source_size": total, "target": rows.target,
                             "n": rows.n, "repeats": repeats, "extra": extra})

    return run


def _key(source: Column) -> Column:
    """A source as a non-null text (null and empty differ)."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED,
        window: int = WINDOW, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per input row: doc_id, source, size, source_size, target, repeats, taken (size * repeats),
    and mark (a 64-bit hash of the row's text, which tells rows with one doc_id apart).

    Null texts have size 0. A document without words costs nothing and is taken ``repeats`` times
    like any other of its source, once at least; its ``taken`` is 0. A null source is a source of its own, the
    last. Repeated rows count as many documents; rows that agree in doc_id and text are told
    apart by reading order alone, so which of them is taken does not matter. An empty table gives
    an empty table; a corpus without words has targets of 0.
    """
    folder = new_folder(docs.sparkSession, "mix")
    ship(docs.sparkSession)
    slim = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _key(F.col("source")).alias("key"),
                              word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("mark")), f"{folder}/slim")
    lengths = stored(slim.groupBy("key", "size").agg(F.first("source").alias("source"), F.count("*").alias("n")),
                     f"{folder}/lengths")
    totals = lengths.groupBy("key").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(totals.drop("key"), weights, most).withColumn("key", _key(F.col("source"))).drop("source")
    fitted = stored(lengths.drop("source").join(goals, "key").groupBy("key").applyInPandas(
        _fit_source(window, most), "key string, size long, source_size long, target double, n long, repeats long, extra long"),
        f"{folder}/fitted")
    order = F.xxhash64(F.lit(seed), "doc_id", "mark")
    cells = F.greatest(F.lit(1), F.ceil(F.col("n") / cell_rows)).cast("long")
    rows = slim.join(fitted, ["key", "size"]).withColumn("order", order).withColumn("cell", F.pmod("order", cells))
    rows = stored(rows, f"{folder}/rows")
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    counts = rows.where(partly).groupBy("key", "size", "cell").agg(F.count("*").alias("in_cell"))
    upto = F.sum("in_cell").over(Window.partitionBy("key", "size").orderBy("cell"))
    counts = counts.withColumn("before", upto - F.col("in_cell"))
    seen = rows.where(partly).join(counts, ["key", "size", "cell"]).withColumn("open", F.col("extra") - F.col("before"))
    cut = (F.col("open") > 0) & (F.col("open") < F.col("in_cell"))
    place = F.row_number().over(Window.partitionBy("key", "size", "cell").orderBy("order", "doc_id"))
    ranked = seen.where(cut).withColumn("one", (place <= F.col("open")).cast("long"))
    out = ["doc_id", "source", "size", "source_size", "target", "repeats", "one", "mark"]
    whole = seen.where(~cut).withColumn("one", (F.col("open") > 0).cast("long"))
    plain = rows.where(~partly).withColumn("one", (F.col("extra") > 0).cast("long"))
    taken = ranked.select(*out).union(whole.select(*out)).union(plain.select(*out))
    times = F.col("repeats") + F.col("one")
    times = F.when(F.col("size") == 0, F.greatest(F.lit(1), times)).otherwise(times)
    return (taken.withColumn("repeats", times)
            .select("doc_id", "source", "size", "source_size", "target", "repeats",
                    (F.col("size") * F.col("repeats")).alias("taken"), "mark"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns unchanged."""
    one, two, three, times, copy = fresh(docs, "id", "mark", "key", "times", "copy")
    chosen = (mix(docs, **options).groupBy("doc_id", "mark", _key(F.col("source")).alias("key"))
              .agg(F.sum("repeats").alias("times")).where("times > 0")
              .select(F.col("doc_id").alias(one), F.col("mark").alias(two), F.col("key").alias(three), F.col("times").alias(times)))
    same = (docs["doc_id"].cast("long").eqNullSafe(chosen[one]) & (F.xxhash64(docs["text"]) == chosen[two])
            & (_key(docs["source"]) == chosen[three]))
    rows = docs.join(chosen, same).dropDuplicates([one, two, three])
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
