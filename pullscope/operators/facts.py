"""Per-PR facts and their source-level summaries: A1, A3, A4, A10, A11, J9."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.operators.labels import merged_only
from pullscope.operators.reports import _median_col, median_by, medians_by, sources_frame

CHANGE_METRICS = ["files_changed", "lines_added", "lines_deleted"]


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """A1: rows per key, null keys dropped (pandas ``groupby`` semantics)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def change_size(details: DataFrame, prefix: str = "") -> DataFrame:
    """A3: per PR distinct files, lines added, lines deleted (an all-null sum is 0)."""
    return (details.where(F.col("pr_id").isNotNull()).groupBy("pr_id")
            .agg(F.count_distinct("filename").alias(prefix + "files_changed"),
                 F.coalesce(F.sum("additions"), F.lit(0)).cast("long").alias(prefix + "lines_added"),
                 F.coalesce(F.sum("deletions"), F.lit(0)).cast("long").alias(prefix + "lines_deleted")))


def attach_source(stats: DataFrame, prs: DataFrame, key: str = "pr_id") -> DataFrame:
    """Bring ``source`` (and ``merged_at``) of the PR to per-PR rows (inner join)."""
    p = prs.select(F.col("id").alias(key), "source", "merged_at")
    return stats.join(p, key, "inner")


def median_by_source(stats: DataFrame, metrics: Sequence[str] = CHANGE_METRICS,
                     method: str = "distributed", empty_as_zero: bool = True) -> DataFrame:
    """A4: median of each metric per source; a source with no rows gives 0.
    ``method`` as in :func:`reports.medians_by`."""
    spark = stats.sparkSession
    agg = medians_by(stats, ["source"], list(metrics), method)
    out = sources_frame(spark).join(agg, "source", "left")
    if empty_as_zero:
        out = out.select("source", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in metrics])
    return out


def commit_counts(prs: DataFrame, commits: DataFrame) -> DataFrame:
    """A1 + J9: commits per PR with the PR's source and merge time (PRs without commits drop)."""
    return attach_source(count_by(commits, "pr_id", "num_commits"), prs)


def single_commit_rate(prs: DataFrame, commits: DataFrame) -> DataFrame:
    """A10: among merged PRs that have commits, the share with exactly one commit."""
    spark = prs.sparkSession
    m = merged_only(commit_counts(prs, commits))
    agg = m.groupBy("source").agg(F.count_if(F.col("num_commits") == 1).alias("single"),
                                  F.count(F.lit(1)).alias("merged_with_commits"))
    out = sources_frame(spark).join(agg, "source", "left").na.fill(0, ["single", "merged_with_commits"])
    return out.withColumn("single_pct", F.when(F.col("merged_with_commits") > 0,
                                               F.col("single") / F.col("merged_with_commits") * 100.0)
                          .otherwise(F.lit(0.0)))


def revised_prs(prs: DataFrame, commits: DataFrame) -> DataFrame:
    """merged PRs with more than one commit (pr_id, source, num_commits)."""
    m = merged_only(commit_counts(prs, commits))
    return m.where(F.col("num_commits") > 1).select("pr_id", "source", "num_commits")


def revised_summary(prs: DataFrame, commits: DataFrame, method: str = "distributed") -> DataFrame:
    """Number of revised PRs and their median commit count per source."""
    spark = prs.sparkSession
    agg = (revised_prs(prs, commits).groupBy("source")
           .agg(F.count(F.lit(1)).alias("revised"),
                *([_median_col(F.col("num_commits"), method == "approx").alias("median_commits")]
                  if method != "distributed" else [])))
    if method == "distributed":
        agg = agg.join(median_by(revised_prs(prs, commits), ["source"], "num_commits", "median_commits"),
                       "source")
    return (sources_frame(spark).join(agg, "source", "left")
            .select("source", F.coalesce("revised", F.lit(0)).cast("long").alias("revised"),
                    "median_commits"))


def fact_pr(prs: DataFrame, commits: DataFrame, details: DataFrame) -> DataFrame:
    """One row per PR with what the report aggregates per PR: change size (null
    when the PR has no detail rows), commit count (null without commits), description words,
    hours to merge. (Revision sizes are per group, not per PR: ``revisions.revision_size_by``.)

    Every per-PR aggregate is keyed by ``pr_id``, so the left joins reuse their partitioning
    and the PR side is shuffled once.
    """
    from pullscope.functions.scalars import hours_between
    from pullscope.functions.words import word_count_long

    cs = change_size(details)
    nc = count_by(commits, "pr_id", "num_commits")
    base = prs.select(F.col("id").alias("pr_id"), "source", "agent", "is_agent", "state", "repo_name",
                      "created_at", "merged_at", word_count_long(prs.sparkSession, "body").alias("desc_words"),
                      F.when(F.col("merged_at").isNotNull(), hours_between("created_at", "merged_at"))
                      .alias("hours_to_merge"))
    return base.join(cs, "pr_id", "left").join(nc, "pr_id", "left")
