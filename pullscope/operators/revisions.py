"""Revision commits: W2, J17, A6.

"First commit of a PR" is the first in stored order, carried as ``commit_seq``.
Two scopes:

* ``global`` (default, the reference's behaviour B6): a sha that is first in *any* revised PR
  is removed everywhere, and details are picked by sha alone, so a PR outside the revised set
  that shares the sha also gets rows.
* ``pr``: per-PR revision commits, details matched on (sha, pr_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.functions.scalars import packed_sha
from pullscope.operators.facts import change_size


def first_commits(commits: DataFrame, order_col: str = "commit_seq") -> DataFrame:
    """(pr_id, first sha) -- ``min_by`` is a partial aggregate, no sort of whole groups."""
    return commits.groupBy("pr_id").agg(F.min_by("sha", order_col).alias("sha"))


#: Keys of null shas, on either side: no packed sha looks like them, so they meet nothing. Without nulls, no filter that one use of a
#: frame needs and another does not keeps the two from sharing what was moved for the first.
NO_COMMIT, NO_DETAIL = b"", b"\x02"


def _keyed(commits: DataFrame) -> DataFrame:
    """What revisions are made of: shas are packed before the commits are moved."""
    return commits.select("pr_id", F.coalesce(packed_sha("sha"), F.lit(NO_COMMIT)).alias("_key"), "commit_seq")


def _revision_shas(rc: DataFrame, by: list[str]) -> DataFrame:
    """(by, _key) of the commits ``rc`` (``_keyed`` ones) but for the shas that are first in any PR of the same group. The first
    commits are joined back by PR: rows that lie by PR are moved once, for both sides, as both need the same columns."""
    firsts = rc.groupBy("pr_id", *by).agg(F.min_by("_key", "commit_seq").alias("_first"), F.min("commit_seq").alias("_seq"))
    is_first = F.coalesce((F.col("_key") == F.col("_first")) & (F.col("commit_seq") == F.col("_seq")), F.lit(False))
    marked = rc.join(firsts, ["pr_id", *by]).select(*by, "_key", is_first.alias("_is_first"))
    return marked.groupBy(*by, "_key").agg(F.bool_or("_is_first").alias("_f")).where(~F.col("_f")).select(*by, "_key")


def _with_key(details: DataFrame) -> DataFrame:
    return details.withColumn("_key", F.coalesce(packed_sha("sha"), F.lit(NO_DETAIL)))


def revision_details(revised: DataFrame, commits: DataFrame, details: DataFrame,
                     scope: str = "global") -> DataFrame:
    """Detail rows of the revision (non-first) commits of revised PRs."""
    ids = revised.select("pr_id")
    if scope == "global":
        rc = _keyed(commits).join(ids, "pr_id", "left_semi")
        return _with_key(details).join(_revision_shas(rc, []), "_key", "left_semi").drop("_key")
    if scope == "pr":
        rc = commits.join(ids, "pr_id", "left_semi")
        firsts = first_commits(rc)
        rev_pairs = rc.select("pr_id", "sha").join(firsts, ["pr_id", "sha"], "left_anti").distinct()
        return details.join(rev_pairs, ["pr_id", "sha"], "left_semi")
    raise ValueError(f"unknown scope {scope!r}")


def revision_size(revised: DataFrame, commits: DataFrame, details: DataFrame,
                  scope: str = "global") -> DataFrame:
    """Per PR ``rev_files_changed``, ``rev_lines_added``, ``rev_lines_deleted``."""
    return change_size(revision_details(revised, commits, details, scope), prefix="rev_")


def revision_size_by(revised: DataFrame, commits: DataFrame, details: DataFrame,
                     group_col: str = "source") -> DataFrame:
    """A6 as the reference computes it per group (one call per source), in one pipeline.

    For each group g: the first shas of g's revised PRs are removed from the shas of g's
    revised PRs; detail rows are then chosen **by sha alone**, so any PR holding such a sha --
    of any group, revised or not -- gets a row under g (B6). Result:
    (group, pr_id, rev_files_changed, rev_lines_added, rev_lines_deleted).
    A sha in the revision sets of two groups is counted in each, as two separate calls would.
    """
    ids = revised.select("pr_id", group_col)
    rc = _keyed(commits).join(ids, "pr_id", "inner")
    rd = _with_key(details).join(_revision_shas(rc, [group_col]), "_key", "inner")
    return (rd.where(F.col("pr_id").isNotNull()).groupBy(group_col, "pr_id")
            .agg(F.count_distinct("filename").alias("rev_files_changed"),
                 F.coalesce(F.sum("additions"), F.lit(0)).cast("long").alias("rev_lines_added"),
                 F.coalesce(F.sum("deletions"), F.lit(0)).cast("long").alias("rev_lines_deleted")))
