"""Landed API payloads -> tables: S6, S7, S8, S14 (+ F11, H13, H14).

The reference fetched these objects over HTTP. Here they are landed files (or a string column)
with one JSON object per line, parsed under an explicit schema -- never inferred, so a batch
of empty commits cannot turn ``filename`` into a null-typed column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.functions.scalars import actor, merged_at_of
from pullscope.schemas import COMMIT_DETAIL_DDL, COMMIT_LIST_DDL, PR_PAYLOAD_DDL

PAGE_SIZE = 100


def _parse(df: DataFrame, ddl: str, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``from_json`` of a text column; malformed lines land in ``_corrupt`` instead of failing. Columns to ``keep`` come along
    with a ``_`` before their names."""
    parsed = F.from_json(F.col(col), ddl + ", _corrupt_record STRING",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    kept = [F.col(k).alias(f"_{k}") for k in keep]
    return (df.select(parsed.alias("_p"), F.col(col).alias("_raw"), *kept)
            .select("_p.*", "_raw", *[f"_{k}" for k in keep])
            .withColumn("_corrupt", F.when(F.col("_corrupt_record").isNotNull() | F.col("_raw").isNull(),
                                           F.coalesce(F.col("_corrupt_record"), F.col("_raw"))))
            .drop("_corrupt_record", "_raw"))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON-lines files as a ``value`` text column (one object per line)."""
    return spark.read.text(path)


# ---- S14 -----------------------------------------------------------------------------------
def failed_keys(pages: DataFrame, key: str) -> DataFrame:
    """Keys with at least one failed page (``bool_or``: one partial aggregate)."""
    return (pages.groupBy(key).agg(F.bool_or(F.coalesce(F.col("page_failed"), F.lit(False))).alias("_f"))
            .where(F.col("_f")).select(key))


# ---- S6 ------------------------------------------------------------------------------------
def pull_requests_from_json(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S6 + F11 + H14: PR-list elements -> PR rows (before labelling).

    The API always sends every key, so a null ``title``/``body`` stays null; only the login of a
    missing or null ``user`` object defaults to ''.

    Returns ``(rows, errors)``. ``errors`` lists repositories with a failed page (their partial
    rows are kept, as in the reference), malformed lines, and well-formed elements without an id. A null ``user`` object gives
    ``user = ''`` (the reference lost the whole repository there, B3).
    """
    p = _parse(raw, PR_PAYLOAD_DDL, col)
    good = p.where(F.col("_corrupt").isNull() & F.col("id").isNotNull())
    rows = good.select(
        F.col("id"), F.col("number"),
        F.col("title"), F.col("body"),
        F.coalesce(F.col("user.login"), F.lit("")).alias("user"),
        F.col("user.id").alias("user_id"),
        F.col("state"), F.col("created_at"),
        F.col("closed_at"),
        merged_at_of(F.col("pull_request"), F.col("merged_at")).alias("merged_at"),
        F.col("repo").alias("repo_name"),
        F.col("html_url"),
    )
    errs = (failed_keys(p.where(F.col("repo").isNotNull()), "repo")
            .select(F.lit("page_failed").alias("kind"), F.col("repo").alias("key"))
            .unionByName(p.where(F.col("_corrupt").isNotNull())
                         .select(F.lit("malformed").alias("kind"), F.col("_corrupt").alias("key")))
            .unionByName(p.where(F.col("_corrupt").isNull() & F.col("id").isNull()
                                 & ~F.coalesce(F.col("page_failed"), F.lit(False)))
                         .select(F.lit("no_id").alias("kind"), F.coalesce("repo", F.lit("")).alias("key"))))
    return rows, errs


# ---- S7 ------------------------------------------------------------------------------------
def commits_from_json(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S7 + H13: commit-list pages -> commit rows with ``commit_seq`` (stored order).

    A PR with any failed page is voided entirely (S14). Returns ``(rows, errors)``; errors are
    (kind, key): failed pages and PRs without any commit by PR id, malformed lines by their text.
    """
    whole = _parse(raw, COMMIT_LIST_DDL, col)
    p = whole.where(F.col("_corrupt").isNull())
    bad = failed_keys(p, "pr_id")
    ok = p.join(bad, "pr_id", "left_anti")
    ex = ok.select("pr_id", "page", F.posexplode("commits").alias("_pos", "c"))
    rows = ex.select(
        F.col("c.sha").alias("sha"), "pr_id",
        actor(F.col("c.author.login"), F.coalesce(F.col("c.commit.author.name"), F.lit(""))).alias("author"),
        actor(F.col("c.committer.login"), F.coalesce(F.col("c.commit.committer.name"), F.lit("")))
        .alias("committer"),
        F.coalesce(F.col("c.commit.message"), F.lit("")).alias("message"),
        ((F.coalesce(F.col("page"), F.lit(1)) - 1) * PAGE_SIZE + F.col("_pos") + 1).cast("int")
        .alias("commit_seq"),
    )
    sizes = p.groupBy("pr_id").agg(F.sum(F.greatest(F.size("commits"), F.lit(0))).alias("_n"),
                                   F.bool_or(F.coalesce(F.col("page_failed"), F.lit(False))).alias("_f"))
    kind = F.when(F.col("_f"), F.lit("page_failed")).when(F.col("_n") == 0, F.lit("empty"))
    errors = (sizes.select(kind.alias("kind"), F.col("pr_id").cast("string").alias("key")).where("kind is not null")
              .unionByName(whole.where(F.col("_corrupt").isNotNull())
                           .select(F.lit("malformed").alias("kind"), F.col("_corrupt").alias("key"))))
    return rows, errors


# ---- S8 ------------------------------------------------------------------------------------
def detail_errors(raw: DataFrame, col: str = "value") -> DataFrame:
    """Lines that ``details_from_json`` cannot use, as (kind, key): malformed, or without a sha."""
    p = _parse(raw, COMMIT_DETAIL_DDL, col)
    kind = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed")).when(F.col("sha").isNull(), F.lit("no_sha"))
    return p.select(kind.alias("kind"), F.coalesce("_corrupt", F.lit("")).alias("key")).where("kind is not null")


def line_sha(col: str = "value") -> Column:
    """The sha of a commit-detail line, read as ``details_from_json`` reads it (of a key that comes twice the last); nothing else is made
    of the line."""
    return F.from_json(F.col(col), "sha string", {"mode": "PERMISSIVE"})["sha"]


def detail_shas(raw: DataFrame, col: str = "value", distinct: bool = True) -> DataFrame:
    """The distinct shas that ``details_from_json`` would give rows for (without ``distinct`` one for each line)."""
    shas = _parse(raw, COMMIT_DETAIL_DDL, col).where(F.col("_corrupt").isNull() & F.col("sha").isNotNull()).select("sha")
    return shas.distinct() if distinct else shas


def details_from_json(raw: DataFrame, col: str = "value", key: str | None = None) -> DataFrame:
    """Commit-detail objects -> one row per file with the payload's commit totals.

    A commit without files yields one row with null file fields; a missing ``status`` is
    'modified'. The result has the columns ``assemble_details`` expects (before J12). ``key`` names a column of the lines' shas in
    another form (``packed_sha`` of ``line_sha``), by which the lines lie: it takes the place of ``sha``.
    """
    p = _parse(raw, COMMIT_DETAIL_DDL, col, () if key is None else (key,)).where(F.col("_corrupt").isNull() & F.col("sha").isNotNull())
    p = p if key is None else p.withColumn("sha", F.col(f"_{key}"))
    ex = p.select("sha", "commit", "stats", F.explode_outer("files").alias("f"))
    has_file = F.col("f").isNotNull()
    return ex.select(
        "sha",
        F.coalesce(F.col("commit.author.name"), F.lit("")).alias("author"),
        F.coalesce(F.col("commit.committer.name"), F.lit("")).alias("committer"),
        F.coalesce(F.col("commit.message"), F.lit("")).alias("message"),
        F.coalesce(F.col("stats.total"), F.lit(0)).cast("long").alias("commit_stats_total"),
        F.coalesce(F.col("stats.additions"), F.lit(0)).cast("long").alias("commit_stats_additions"),
        F.coalesce(F.col("stats.deletions"), F.lit(0)).cast("long").alias("commit_stats_deletions"),
        F.col("f.filename").alias("filename"),
        F.when(has_file, F.coalesce(F.col("f.status"), F.lit("modified"))).alias("status"),
        F.when(has_file, F.coalesce(F.col("f.additions"), F.lit(0))).cast("long").alias("additions"),
        F.when(has_file, F.coalesce(F.col("f.deletions"), F.lit(0))).cast("long").alias("deletions"),
        F.col("f.patch").alias("patch"),
    )
