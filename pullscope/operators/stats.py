"""Tests of difference and distribution shapes: A21-A24, W1, A26.

All statistics reduce the data first (counts per cell, counts per distinct value, counts per
value on a grid) and finish on a handful of rows, so no group is ever collected.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pullscope.functions.mathx import chi2_sf_1df, normal_sf
from pullscope.functions.scalars import log10_clip
from pullscope.operators.reports import quantiles_by

ALPHA = 0.05


# ---- A21 ---------------------------------------------------------------------------------
def chi2_merge_rate(prs: DataFrame, group_col: str = "source", a: str = "agent", b: str = "human",
                    flag: str = "merged_at") -> DataFrame:
    """2x2 chi-squared test of merge rate with Yates' correction.

    Computed only when all four cells are positive (else chi2/p are null).
    chi2 = n * max(0, |ad - bc| - n/2)^2 / ((a+b)(c+d)(a+c)(b+d)); p = erfc(sqrt(chi2/2)).
    """
    g, m = F.col(group_col), F.col(flag).isNotNull()
    cells = prs.agg(F.count_if((g == a) & m).cast("double").alias("a"),
                    F.count_if((g == a) & ~m).cast("double").alias("b"),
                    F.count_if((g == b) & m).cast("double").alias("c"),
                    F.count_if((g == b) & ~m).cast("double").alias("d"))
    return _chi2(cells)


def chi2_of_counts(counts: DataFrame, total: str = "total", merged: str = "merged", group_col: str = "source",
                   a: str = "agent", b: str = "human") -> DataFrame:
    """A21 from one row per group with its merged and total counts."""
    g, m, n = F.col(group_col), F.col(merged), F.col(total)
    return _chi2(counts.agg(*[F.coalesce(F.sum(F.when(g == who, x)), F.lit(0)).cast("double").alias(name)
                              for who, x, name in ((a, m, "a"), (a, n - m, "b"), (b, m, "c"), (b, n - m, "d"))]))


def _chi2(cells: DataFrame) -> DataFrame:
    A, B, C, D = (F.col(x) for x in "abcd")
    n = A + B + C + D
    chi2 = F.when(F.least(A, B, C, D) > 0,
                  n * F.pow(F.greatest(F.lit(0.0), F.abs(A * D - B * C) - n / 2.0), 2)
                  / ((A + B) * (C + D) * (A + C) * (B + D)))
    out = cells.select(A.cast("long").alias("agent_merged"), (A + B).cast("long").alias("agent_total"),
                       C.cast("long").alias("human_merged"), (C + D).cast("long").alias("human_total"),
                       chi2.alias("chi2"))
    out = out.withColumn("p_value", chi2_sf_1df(F.col("chi2")))
    return out.withColumn("significant", F.col("p_value") < ALPHA)


# ---- A22 + W1 ----------------------------------------------------------------------------
def rank_table(df: DataFrame, value: str, group_col: str, a: str, buckets: int = 128) -> DataFrame:
    """Mid-rank of every distinct value, with per-group counts.

    Two-level prefix sum: counts per distinct value, totals per bucket between ``buckets - 1`` cut
    points of a quantile sketch over the distinct values, a running sum over these buckets
    (``buckets`` rows, whatever the range of values), then a running sum inside each bucket
    partition. No window ever spans all distinct values in one task.
    """
    v = F.col(value)
    cnt = (df.where(v.isNotNull()).groupBy(v.alias("v"))
           .agg(F.count_if(F.col(group_col) == a).alias("na"),
                F.count_if(F.col(group_col) != a).alias("nb"),
                F.count(F.lit(1)).alias("t")))
    cuts = cnt.agg(F.percentile_approx("v", [i / buckets for i in range(1, buckets)], 10 * buckets).alias("c")).scalar()
    cnt = cnt.withColumn("_cuts", cuts).withColumn("bucket", F.size(F.filter("_cuts", lambda x: x < F.col("v")))).drop("_cuts")
    btot = cnt.groupBy("bucket").agg(F.sum("t").alias("bt"))
    boff = btot.withColumn("boff", F.coalesce(F.sum("bt").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("bt")
    inner = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cnt.join(boff, "bucket").withColumn(
        "before", F.col("boff") + F.coalesce(F.sum("t").over(inner), F.lit(0)))
    return ranked.withColumn("midrank", F.col("before") + (F.col("t") + 1) / 2.0)


EXACT_ROWS = 8


def mann_whitney(df: DataFrame, value: str, group_col: str = "source", a: str = "agent",
                 b: str = "human", method: str = "asymptotic") -> DataFrame:
    """A22 + A26: two-sided Mann-Whitney U of ``value`` between groups ``a`` and ``b``.

    U is the statistic of group ``a``; the p-value uses the normal approximation with tie
    correction and 0.5 continuity (the asymptotic method); without any spread it is 1. With
    ``method="auto"`` the p-value is exact when one sample has at most ``EXACT_ROWS`` rows and there are no
    ties: the null distribution is built on the driver from the one-row result. Empty when either
    group is empty.
    """
    out = _mann_whitney(df, value, group_col, a, b)
    if method == "auto":
        rows = out.collect()  # one row
        if rows and min(rows[0]["n_agent"], rows[0]["n_human"]) <= EXACT_ROWS and not rows[0]["has_ties"]:
            p = exact_p_value(rows[0]["u_statistic"], rows[0]["n_agent"], rows[0]["n_human"])
            out = out.withColumn("p_value", F.lit(p)).withColumn("significant", F.lit(p < ALPHA))
    return out


def _mann_whitney(df: DataFrame, value: str, group_col: str, a: str, b: str) -> DataFrame:
    rt = rank_table(df.where(F.col(group_col).isin(a, b)), value, group_col, a)
    tot = rt.agg(F.sum("na").cast("double").alias("n1"), F.sum("nb").cast("double").alias("n2"),
                 F.sum(F.col("na") * F.col("midrank")).alias("r1"),
                 F.sum(F.pow(F.col("t"), 3) - F.col("t")).cast("double").alias("tie"),
                 F.max("t").alias("max_tie"))
    n1, n2 = F.col("n1"), F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    out = tot.where((n1 > 0) & (n2 > 0)).withColumn("u1", u1)
    um = F.greatest(F.col("u1"), n1 * n2 - F.col("u1"))
    n = n1 + n2
    sd = F.sqrt(F.greatest(F.lit(0.0), n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1)))))
    z = F.try_divide(um - n1 * n2 / 2.0 - 0.5, F.nullif(sd, F.lit(0.0)))
    p = F.coalesce(F.least(F.lit(1.0), F.lit(2.0) * normal_sf(z)), F.lit(1.0))  # no spread: p = 1
    return out.select(n1.cast("long").alias("n_agent"), n2.cast("long").alias("n_human"),
                      F.col("u1").alias("u_statistic"), p.alias("p_value"),
                      (F.col("max_tie") > 1).alias("has_ties"), (p < ALPHA).alias("significant"))


def exact_p_value(u1: float, n1: int, n2: int) -> float:
    """Exact two-sided p of U for small samples without ties (scipy's 'exact' method).

    The null distribution of U is the coefficient list of the Gaussian binomial
    [n1+n2 choose n1]_q, built by polynomial products: O(min(n1,n2) * n1 * n2).
    """
    m, n = sorted((int(n1), int(n2)))
    dist = [1]
    # product over i=1..m of (1 - q^(n+i)) / (1 - q^i)
    for i in range(1, m + 1):
        deg = n + i
        nxt = dist + [0] * deg
        for k in range(len(dist) - 1, -1, -1):
            nxt[k + deg] -= dist[k]
        # divide by (1 - q^i)
        for k in range(i, len(nxt)):
            nxt[k] += nxt[k - i]
        dist = nxt[: m * n + 1] if len(nxt) > m * n + 1 else nxt
    total = math.comb(m + n, m)
    u = max(u1, m * n - u1)
    sf = sum(dist[int(math.ceil(u)):]) / total
    return min(1.0, 2.0 * sf)


# ---- A23 / A24 ---------------------------------------------------------------------------
def violin(df: DataFrame, value: str, group_col: str = "source", log: bool = True,
           clip_upper: float | None = None, grid: int = 100, bw_adjust: float = 0.5) -> DataFrame:
    """Violin shape per group -- Gaussian density on ``grid`` points from min to max.

    Bandwidth: Scott's rule (sd * N^(-1/5)) times ``bw_adjust``. ``log`` works in
    log10 space after clipping below at 1; ``clip_upper`` clips above (the revision plot clips
    at min(max, 50)). Density is also scaled to a maximum of 1 per group (width norm).

    Plan: counts per distinct (group, value) -> join to per-group statistics (one row per
    group) -> ``grid`` contributions per distinct value -> sum per grid point (partial
    aggregation, so a hot group is spread over all tasks).
    """
    x = F.col(value).cast("double")
    if clip_upper is not None:
        mx = df.agg(F.max(x).alias("_m"))
        bound = F.least(F.lit(float(clip_upper)), mx.select("_m").scalar())
        x = F.least(x, bound)
    if log:
        x = log10_clip(x)
    vals = df.where(F.col(value).isNotNull()).select(F.col(group_col).alias("grp"), x.alias("x"))
    cnt = vals.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("n"))
    st = (vals.groupBy("grp").agg(F.count(F.lit(1)).alias("n_all"), F.min("x").alias("lo"),
                                  F.max("x").alias("hi"), F.stddev_samp("x").alias("sd"))
          .withColumn("h", F.col("sd") * F.pow(F.col("n_all").cast("double"), -0.2) * bw_adjust))
    j = cnt.join(st.select("grp", "n_all", "lo", "hi", "h"), "grp")
    j = j.select("grp", "x", "n", "n_all", "lo", "hi", "h",
                 F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    gx = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / float(grid - 1)
    contrib = F.col("n") * F.exp(-0.5 * F.pow(F.try_divide(gx - F.col("x"), F.col("h")), 2))
    dens = (j.groupBy("grp", "i").agg(F.sum(contrib).alias("_s"), F.first("n_all").alias("n_all"),
                                      F.first("h").alias("h"), F.first("lo").alias("lo"),
                                      F.first("hi").alias("hi")))
    dens = dens.select("grp", "i", (F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo"))
                                    / float(grid - 1)).alias("grid_x"),
                       F.try_divide(F.col("_s"), F.col("n_all") * F.col("h") * math.sqrt(2 * math.pi)).alias("density"))
    w = Window.partitionBy("grp")
    dens = dens.withColumn("density_scaled", F.try_divide(F.col("density"), F.max("density").over(w)))
    box = quantiles_by(vals, ["grp"], "x", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return dens.join(box, "grp").withColumnRenamed("grp", group_col)
