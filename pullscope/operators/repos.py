"""Repository export and coverage: J4-J6, A1, A2, A20, H2-H4, L1, F8, Q3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pullscope.functions.scalars import clean_url, final_name, pct


def first_non_null(col: str, order_col: str) -> Column:
    """A2: the first non-null value of ``col`` in ``order_col`` order (pandas ``first``).

    ``min_by`` over an order that is null for null values: a partial aggregate whose result
    does not depend on partitioning (unlike ``first(ignorenulls)``).
    """
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(order_col)))


def repo_agg(prs: DataFrame, order_col: str = "id", key: str = "repo_id",
             url_cols: Sequence[str] = ("repo_url", "html_url")) -> DataFrame:
    """J4 + A1 + A2: PR count and first non-null URLs per repository, in one aggregate
    (the reference's two group-bys and their join collapse into one)."""
    return (prs.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("pr_count"),
                 *[first_non_null(c, order_col).alias(c) for c in url_cols]))


def repo_export(baseline: DataFrame, repos: DataFrame, order_col: str = "id") -> DataFrame:
    """Per-repository export (``sorted_export`` gives L1's order). The membership flag is
    whether the one metadata join found a row.

    A repository id listed twice in the metadata multiplies its row, as in the reference.
    """
    agg = repo_agg(baseline, order_col)
    meta = repos.select(F.col("id").alias("repo_id"), "url", "license", "full_name",
                        "language", "forks", "stars")
    out = agg.join(meta.withColumn("_in_meta", F.lit(True)), "repo_id", "left")
    out = out.select(
        "repo_id",
        final_name("full_name", "html_url", "repo_url").alias("repository"),
        "pr_count",
        F.coalesce(F.col("_in_meta"), F.lit(False)).alias("in_repository_metadata"),
        "language", "stars", "forks", "license", "repo_url",
        clean_url("html_url").alias("html_url"),
    )
    return out


def sorted_export(export: DataFrame) -> DataFrame:
    """L1: ``pr_count`` desc, ``repository`` asc (the CSV order)."""
    return export.orderBy(F.desc("pr_count"), F.asc("repository"), F.asc("repo_id"))


def top_exported(export: DataFrame, k: int = 10) -> DataFrame:
    """L2 on the export: the first ``k`` rows of the sorted export (a top-k, not a full sort)."""
    return sorted_export(export).select("repository", "repo_id", "pr_count",
                                        "in_repository_metadata").limit(k)


def recovered_names(export: DataFrame) -> DataFrame:
    """F8: names recovered from URLs for repositories missing from the metadata."""
    return export.where((F.col("repository") != "Unknown") & ~F.col("in_repository_metadata"))


def coverage(a: DataFrame, b: DataFrame, key_a: str, key_b: str, base: str = "a") -> DataFrame:
    """Sizes of A, B, A and B, A minus B, and the percentage of the base set covered.

    A full outer join of the two distinct key sets with markers; one pass, partial aggregates.
    ``base`` picks the denominator ('a' or 'b'); the reference uses both conventions.
    """
    ka = a.select(F.col(key_a).alias("_k")).where(F.col("_k").isNotNull()).distinct() \
        .withColumn("_a", F.lit(True))
    kb = b.select(F.col(key_b).alias("_k")).where(F.col("_k").isNotNull()).distinct() \
        .withColumn("_b", F.lit(True))
    j = ka.join(kb, "_k", "full_outer")
    out = j.agg(F.count_if(F.col("_a")).alias("size_a"), F.count_if(F.col("_b")).alias("size_b"),
                F.count_if(F.col("_a") & F.col("_b")).alias("overlap"),
                F.count_if(F.col("_a") & F.col("_b").isNull()).alias("only_a"))
    den = F.col("size_a") if base == "a" else F.col("size_b")
    return out.withColumn("coverage_pct", pct(F.col("overlap"), den))


def metadata_report(baseline: DataFrame, repos: DataFrame, export: DataFrame) -> DataFrame:
    """Q3: metadata inconsistency summary of the export step (one row)."""
    cov = coverage(baseline, repos, "repo_id", "id", base="a")
    rec = recovered_names(export).agg(F.count(F.lit(1))).scalar()
    meta = repos.agg(F.count_distinct("id")).scalar()
    return cov.select(F.col("size_a").alias("repos_in_prs"), "overlap",
                      F.col("only_a").alias("missing_from_metadata"), F.col("coverage_pct"),
                      meta.alias("repos_in_metadata"), rec.alias("names_recovered"))
