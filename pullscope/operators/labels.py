"""Author labelling, repository lookup, title classification and row filters.

J1-J3, J7/J8, F1-F10 and the use of H1. All operators are lazy ``DataFrame -> DataFrame``.
Lookups are left joins: the planner (with AQE's runtime sizes) decides whether a side is small
enough to broadcast; nothing is broadcast by assumption because the user and repository
dimensions grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pullscope.functions.scalars import AGENT_LABELS, api_repo_url, classify_title, packed_sha, unpacked_sha


# ---- F1 / J1 -----------------------------------------------------------------------------
def filter_agents(df: DataFrame, labels: Sequence[str] = AGENT_LABELS,
                  col: str = "agent") -> DataFrame:
    """keep rows whose agent label is one of ``labels`` (pushed to the Parquet scan)."""
    return df.where(F.col(col).isin(list(labels)))


def target_repos(repos: DataFrame, baseline: DataFrame, repo_key: str = "id",
                 baseline_key: str = "repo_id") -> DataFrame:
    """Repositories that hold at least one baseline (agent) PR."""
    keys = baseline.select(F.col(baseline_key).alias(repo_key)).where(F.col(repo_key).isNotNull())
    return repos.join(keys, repo_key, "left_semi")


# ---- J2 ----------------------------------------------------------------------------------
def user_agent_dim(baseline: DataFrame, order_col: str = "id", user_col: str = "user",
                   agent_col: str = "agent") -> DataFrame:
    """J2 dimension: one label per user.

    Distinct (user, agent) pairs are ordered by their first appearance in the baseline; when a
    user carries several labels the **last** of these pairs wins (rows A, B, A give B).
    Two partial aggregates, no window: each shuffles only (user, agent) pairs.
    """
    pairs = (baseline.where(F.col(user_col).isNotNull() & F.col(agent_col).isNotNull())
             .groupBy(user_col, agent_col).agg(F.min(order_col).alias("_first")))
    return pairs.groupBy(user_col).agg(F.max_by(agent_col, "_first").alias("_label"))


def label_author(prs: DataFrame, dim: DataFrame, user_col: str = "user") -> DataFrame:
    """(is_agent, agent) from the user dimension; no match -> (False, 'human')."""
    out = prs.join(dim, user_col, "left")
    return (out.withColumn("is_agent", F.col("_label").isNotNull())
               .withColumn("agent", F.coalesce(F.col("_label"), F.lit("human")))
               .drop("_label"))


# ---- J3 ----------------------------------------------------------------------------------
def repo_id_dim(repos: DataFrame, order_col: str = "id", name_col: str = "full_name",
                id_col: str = "id") -> DataFrame:
    """J3 dimension: ``full_name -> id``; with duplicate names the last one (in order) wins."""
    return (repos.where(F.col(name_col).isNotNull())
            .groupBy(F.col(name_col).alias("_rname"))
            .agg(F.max_by(id_col, order_col).alias("_rid")))


def attach_repo_id(prs: DataFrame, dim: DataFrame, name_col: str = "repo_name") -> DataFrame:
    """``repo_id`` by repository name; no match -> null. Adds the API ``repo_url``."""
    out = prs.join(dim, prs[name_col] == dim["_rname"], "left")
    return (out.withColumn("repo_id", F.col("_rid").cast("long"))
               .withColumn("repo_url", api_repo_url(F.col(name_col)))
               .drop("_rname", "_rid"))


# ---- F2 / F3 -----------------------------------------------------------------------------
def filter_created(df: DataFrame, date_from: str, date_to: str, col: str = "created_at") -> DataFrame:
    """inclusive window on ISO text; the upper bound is ``date_to`` + 'T23:59:59Z'.

    Compared as strings, exactly like the reference. Parquet row-group statistics on a table
    sorted by ``created_at`` give the early stop of F3 for free.
    """
    c = F.col(col)
    return df.where((c >= F.lit(date_from)) & (c <= F.lit(date_to + "T23:59:59Z")))


# ---- F4-F7, F10 --------------------------------------------------------------------------
def source_of(is_agent: str = "is_agent") -> Column:
    return F.when(F.col(is_agent), F.lit("agent")).otherwise(F.lit("human"))


def split_by_source(df: DataFrame, is_agent: str = "is_agent") -> tuple[DataFrame, DataFrame]:
    """(agent rows, human rows)."""
    return df.where(F.col(is_agent)), df.where(~F.col(is_agent))


def with_type(df: DataFrame, source: str | Column | None = None, title: str = "title") -> DataFrame:
    """F10 + H1: add ``type`` ('fix'/'other') and ``source``."""
    src = source_of() if source is None else (F.lit(source) if isinstance(source, str) else source)
    return df.withColumn("type", classify_title(title)).withColumn("source", src)


def classify_prs(agent_prs: DataFrame, human_prs: DataFrame) -> DataFrame:
    """U1 + F10: label both files and union them (the shape of the reference's step)."""
    return with_type(agent_prs, "agent").unionByName(with_type(human_prs, "human"))


def classify_all(prs: DataFrame) -> DataFrame:
    """Single-scan form of :func:`classify_prs`: ``source`` from ``is_agent``."""
    return with_type(prs)


def fix_only(df: DataFrame) -> DataFrame:
    """F5."""
    return df.where(F.col("type") == "fix")


def merged_only(df: DataFrame, col: str = "merged_at") -> DataFrame:
    """F6."""
    return df.where(F.col(col).isNotNull())


# ---- J7 / J8 -----------------------------------------------------------------------------
def filter_to_prs(df: DataFrame, prs: DataFrame, key: str = "pr_id", id_col: str = "id") -> DataFrame:
    """Rows whose ``pr_id`` is among the PR ids (semi-join: never multiplies rows). A ``sha`` is moved packed."""
    ids = prs.select(F.col(id_col).alias(key))
    if "sha" not in df.columns:
        return df.join(ids, key, "left_semi")
    kept = df.withColumn("sha", packed_sha("sha")).join(ids, key, "left_semi")
    return kept.withColumn("sha", unpacked_sha("sha")).select(*df.columns)
