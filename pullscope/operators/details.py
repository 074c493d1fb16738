"""Commit-detail assembly: J12-J16 and A5.

Grain of the result: (sha, pr_id, filename). Patches (up to 1 MB each) are attached last, by
(sha, filename), so the heavy column never rides through the fan-out shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from pullscope.functions.scalars import packed_sha, unpacked_sha
from pullscope.schemas import COMMIT_DETAILS


def commit_totals(files: DataFrame, sha: str = "sha") -> DataFrame:
    """A5: per-commit totals on every file row (a commit without files sums to 0).

    A window partitioned by ``sha`` leaves the rows hash-partitioned on ``sha``; the fan-out
    join that follows on the same key reuses that partitioning.
    """
    w = Window.partitionBy(sha)
    adds = F.coalesce(F.sum("additions").over(w), F.lit(0)).cast("long")
    dels = F.coalesce(F.sum("deletions").over(w), F.lit(0)).cast("long")
    return (files.withColumn("commit_stats_additions", adds)
                 .withColumn("commit_stats_deletions", dels)
                 .withColumn("commit_stats_total", F.col("commit_stats_additions")
                             + F.col("commit_stats_deletions")))


def expand_to_prs(files: DataFrame, bridge: DataFrame, sha: str = "sha",
                  keep_orphans: bool = False) -> DataFrame:
    """Repeat each commit's rows for every PR holding the sha.

    In the collection flow every sha comes from the bridge, so one inner join is exact; it is
    also a join AQE can split when one sha is very hot. ``keep_orphans`` adds the shas without
    a PR (``pr_id`` null) through an anti join -- again splittable, where a left join with a
    skewed right side would not be. Duplicate (sha, pr_id) pairs in the bridge multiply rows,
    as in the reference.
    """
    b = bridge.select(sha, "pr_id").where(F.col(sha).isNotNull())
    matched = files.join(b, sha, "inner")
    if not keep_orphans:
        return matched
    orphans = files.join(b, sha, "left_anti").withColumn("pr_id", F.lit(None).cast("long"))
    return matched.unionByName(orphans)


def attach_status(numstat: DataFrame, statuses: DataFrame) -> DataFrame:
    """Status word by (sha, filename); no match -> 'modified'."""
    s = statuses.select("sha", "filename", F.col("status").alias("_st"))
    out = numstat.join(s, ["sha", "filename"], "left")
    return out.withColumn("status", F.when(F.col("filename").isNull(), F.lit(None).cast("string"))
                          .otherwise(F.coalesce(F.col("_st"), F.lit("modified")))).drop("_st")


def attach_patch(rows: DataFrame, patches: DataFrame) -> DataFrame:
    """Patch text by (sha, filename); none -> null."""
    p = patches.select("sha", "filename", F.col("patch").alias("_patch"))
    out = rows.join(p, ["sha", "filename"], "left")
    if "patch" in out.columns:
        out = out.drop("patch")
    return out.withColumnRenamed("_patch", "patch")


def prefer(primary: DataFrame, fallback: DataFrame, keys: DataFrame,
           key: str = "sha") -> tuple[DataFrame, DataFrame]:
    """Rows of ``primary``; for keys it lacks, rows of ``fallback``; the rest are missing.

    Returns ``(rows, missing_keys)``. Both inputs must share column names.
    """
    fb = fallback.join(primary.select(key).distinct(), key, "left_anti")
    rows = primary.unionByName(fb, allowMissingColumns=True)
    have = rows.select(key).distinct()
    missing = keys.select(key).distinct().join(have, key, "left_anti")
    return rows, missing


def assemble_details(files: DataFrame, bridge: DataFrame, keep_orphans: bool = False, sha_text: Column | None = None) -> DataFrame:
    """S8/S9 rows -> ``commit_details``: totals (A5), fan-out (J12), ``changes``.

    ``files`` carries sha, author, committer, message, filename, status, additions,
    deletions and optionally patch; a commit without files is one row with null file.
    Rows that already carry payload totals (API form) keep them. Where ``files`` has its shas packed
    (``packed_sha``), totals and fan-out go by the packed ones (the bridge may have either form); the result has them as text.
    ``sha`` may also be another key that stands for it in both; ``sha_text`` is then its text.
    """
    packed = isinstance(files.schema["sha"].dataType, BinaryType)
    if packed and not isinstance(bridge.schema["sha"].dataType, BinaryType):
        bridge = bridge.withColumn("sha", packed_sha("sha"))
    has_totals = "commit_stats_total" in files.columns
    f = files if has_totals else commit_totals(files)
    if "patch" not in f.columns:
        f = f.withColumn("patch", F.lit(None).cast("string"))
    f = f.withColumn("changes", (F.col("additions") + F.col("deletions")).cast("long"))
    out = expand_to_prs(f, bridge, keep_orphans=keep_orphans)
    if packed or sha_text is not None:
        out = out.withColumn("sha", unpacked_sha("sha") if sha_text is None else sha_text)
    return out.select([F.col(c.name).cast(c.dataType) for c in COMMIT_DETAILS.fields])


def lean_details(details: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column-pruned view (S3): never carries the patch column."""
    from pullscope.schemas import LEAN_DETAIL_COLUMNS
    return details.select(*(columns or LEAN_DETAIL_COLUMNS))


def sha_repo(commits: DataFrame, prs: DataFrame, order: Sequence[str] = ("pr_id", "commit_seq")
             ) -> tuple[DataFrame, DataFrame]:
    """Sha -> repository of the first commit row (by ``order``: columns of ``commits``, such as the
    stored row order) whose PR has a known, non-empty repository. Returns ``(sha_repo, unmatched_shas)``; the reference only warned
    about the unmatched ones."""
    known = prs.select(F.col("id").alias("pr_id"), "repo_name").where(F.col("repo_name").isNotNull() & (F.col("repo_name") != ""))
    j = commits.select("sha", *dict.fromkeys(["pr_id", *order])).join(known, "pr_id", "inner")
    m = j.groupBy("sha").agg(F.min_by("repo_name", F.struct(*order)).alias("repo_name"))
    unmatched = commits.select("sha").distinct().join(m, "sha", "left_anti")
    return m, unmatched


def batch_keys(sha_repos: DataFrame, batch_size: int = 500) -> DataFrame:
    """Split each repository's shas into batches of about ``batch_size`` by hash, so a hot
    repository becomes many bounded groups (no per-repository sort)."""
    n = sha_repos.groupBy("repo_name").agg(F.count(F.lit(1)).alias("_n"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(batch_size)))
    return (sha_repos.join(n, "repo_name")
            .withColumn("batch", F.pmod(F.xxhash64("sha"), nb)).drop("_n"))
