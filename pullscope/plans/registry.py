"""Registered queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query maps the driver tables to the PR data model (``sources.fixtures``), runs the
classification flow and applies one operator. Doubles are rounded to 6 digits for the
comparison with the DuckDB oracle (``plans/oracle.py``), which rounds the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.operators import facts, labels, reports, repos, revisions, stats
from pullscope.plans.classify import classify
from pullscope.session import apply_conf
from pullscope.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _fix(spark: SparkSession, d: str, with_body: bool = False, with_details: bool = True, with_commits: bool = True):
    prs = fx.pull_requests(spark, d)
    cm = fx.commits(spark, d) if with_commits else None
    dt = fx.commit_details(spark, d) if with_details else None
    r = classify(prs, cm, dt)
    if with_body:  # joined to the PRs only: the cuts of commits and details need their ids
        r.classified, r.fix_prs = fx.with_body(spark, d, r.classified), fx.with_body(spark, d, r.fix_prs)
    return r


# ---- classification ------------------------------------------------------------------------
@register("classified_prs")
def q_classified_prs(spark, d):
    """H1 + F10 + U1: every PR with ``type`` and ``source``."""
    return _fix(spark, d, with_body=True, with_details=False, with_commits=False).classified


@register("fix_prs_only")
def q_fix_prs_only(spark, d):
    """fix PRs."""
    return _fix(spark, d, with_body=True, with_details=False, with_commits=False).fix_prs


@register("source_type_crosstab")
def q_crosstab(spark, d):
    """A13."""
    return _fix(spark, d, with_details=False, with_commits=False).summary()


@register("fix_pr_commits")
def q_fix_commits(spark, d):
    """J7."""
    return _fix(spark, d, with_details=False).fix_commits


@register("fix_pr_commit_details")
def q_fix_details(spark, d):
    """J8 + S3 (lean columns)."""
    return _fix(spark, d).fix_details


@register("commit_details")
def q_commit_details(spark, d):
    """S8-shaped files + A5 + J12 (+H19): the full details table (without patch)."""
    return fx.commit_details(spark, d).drop("patch")


@register("pull_requests")
def q_pull_requests(spark, d):
    """F2 + J2 + J3 + H15: the collector's PR table (without body)."""
    return fx.pull_requests(spark, d, window=(fx.WINDOW_FROM, fx.WINDOW_TO)).drop("body")


@register("target_repos")
def q_target_repos(spark, d):
    """J1 + F1: repositories holding agent PRs."""
    return labels.target_repos(fx.repository(spark, d), labels.filter_agents(fx.baseline(spark, d)))


@register("user_agent_labels")
def q_user_agent(spark, d):
    """J2 dimension: last label by first appearance."""
    dim = labels.user_agent_dim(labels.filter_agents(fx.baseline(spark, d)))
    return dim.select("user", F.col("_label").alias("agent"))


# ---- report: overview and RQ1 --------------------------------------------------------------
@register("overview")
def q_overview(spark, d):
    """A25 + A15 + A16."""
    r = _fix(spark, d, with_details=False)
    return reports.overview(r.fix_prs, r.fix_commits)


@register("agent_breakdown")
def q_agent_breakdown(spark, d):
    """A12 over agent fix PRs."""
    r = _fix(spark, d, with_details=False, with_commits=False)
    return reports.value_counts(r.fix_prs.where(F.col("source") == "agent"), "agent")


@register("state_breakdown")
def q_state_breakdown(spark, d):
    """A12 per source."""
    r = _fix(spark, d, with_details=False, with_commits=False)
    return reports.value_counts(r.fix_prs, "state", by=["source"])


@register("pr_change_size")
def q_pr_change_size(spark, d):
    """A3 + J9: per-PR change size with source."""
    r = _fix(spark, d)
    return facts.attach_source(facts.change_size(r.fix_details), r.fix_prs).drop("merged_at")


@register("change_size_by_source")
def q_change_size(spark, d):
    """A4: median change size per source."""
    r = _fix(spark, d)
    return facts.median_by_source(facts.attach_source(facts.change_size(r.fix_details), r.fix_prs))


@register("description_length")
def q_description_length(spark, d):
    """A8 + H5."""
    r = _fix(spark, d, with_body=True, with_details=False, with_commits=False)
    return reports.description_length(r.fix_prs)


# ---- RQ2 -----------------------------------------------------------------------------------
@register("merge_rate_by_source")
def q_merge_rate_source(spark, d):
    """A7 per source."""
    return reports.merge_rate_by_source(_fix(spark, d, with_details=False, with_commits=False).fix_prs)


@register("merge_rate_by_agent")
def q_merge_rate_agent(spark, d):
    """A7 per agent tool over agent fix PRs (the flagship query)."""
    r = _fix(spark, d, with_details=False, with_commits=False)
    return reports.merge_rate(r.fix_prs.where(F.col("source") == "agent"), "agent")


@register("merge_rate_sets")
def q_merge_rate_sets(spark, d):
    """A7 overall / per source / per agent as one GROUPING SETS aggregate."""
    return reports.merge_rate_sets(_fix(spark, d, with_details=False, with_commits=False).fix_prs)


@register("merge_rate_chi2")
def q_chi2(spark, d):
    """A21 + A26."""
    return stats.chi2_merge_rate(_fix(spark, d, with_details=False, with_commits=False).fix_prs)


@register("time_to_merge")
def q_time_to_merge(spark, d):
    """A9 + H6."""
    return reports.time_to_merge(_fix(spark, d, with_details=False, with_commits=False).fix_prs)


# ---- RQ3 -----------------------------------------------------------------------------------
@register("single_commit_rate")
def q_single_commit(spark, d):
    """A10."""
    r = _fix(spark, d, with_details=False)
    return facts.single_commit_rate(r.fix_prs, r.fix_commits)


@register("revised_summary")
def q_revised_summary(spark, d):
    """A11 + F7."""
    r = _fix(spark, d, with_details=False)
    return facts.revised_summary(r.fix_prs, r.fix_commits)


@register("mann_whitney_revisions")
def q_mwu(spark, d):
    """A22 + W1: commit counts of revised PRs, agent vs human."""
    r = _fix(spark, d, with_details=False)
    return stats.mann_whitney(facts.revised_prs(r.fix_prs, r.fix_commits), "num_commits").drop("has_ties")


@register("revision_size_pr")
def q_revision_size_pr(spark, d):
    """W2 + J17 + A6 (global sha set, the reference's behaviour)."""
    r = _fix(spark, d)
    rev = facts.revised_prs(r.fix_prs, r.fix_commits)
    return revisions.revision_size(rev, r.fix_commits, r.fix_details, scope="global")


@register("revision_size_pr_scope")
def q_revision_size_pr_scope(spark, d):
    """A6 with per-PR revision commits."""
    r = _fix(spark, d)
    rev = facts.revised_prs(r.fix_prs, r.fix_commits)
    return revisions.revision_size(rev, r.fix_commits, r.fix_details, scope="pr")


@register("revision_size_rows_by_source")
def q_revision_rows_source(spark, d):
    """A6 per source (B6 semantics): (source, pr_id, rev_*) for every PR holding a revision sha
    of that source's revised PRs."""
    r = _fix(spark, d)
    rev = facts.revised_prs(r.fix_prs, r.fix_commits)
    return revisions.revision_size_by(rev, r.fix_commits, r.fix_details, "source")


@register("revision_size_by_source")
def q_revision_size_source(spark, d):
    """A6 medians per source, one revision computation per source as the reference does."""
    r = _fix(spark, d)
    rev = facts.revised_prs(r.fix_prs, r.fix_commits)
    rs = revisions.revision_size_by(rev, r.fix_commits, r.fix_details, "source")
    return facts.median_by_source(rs, ["rev_files_changed", "rev_lines_added", "rev_lines_deleted"])


# ---- additional statistics -----------------------------------------------------------------
@register("monthly_volume")
def q_monthly(spark, d):
    """A14 + H7."""
    return reports.monthly_volume(_fix(spark, d, with_details=False, with_commits=False).fix_prs)


@register("top_repos")
def q_top_repos(spark, d):
    """J18 + L2."""
    return reports.top_repos(_fix(spark, d, with_details=False, with_commits=False).fix_prs, 10)


# ---- repository export ---------------------------------------------------------------------
def _export(spark, d):
    return repos.repo_export(fx.baseline(spark, d), fx.repository(spark, d))


@register("repo_export")
def q_repo_export(spark, d):
    """J4-J6 + A1 + A2 + H2-H4."""
    return _export(spark, d)


@register("top_exported_repos")
def q_top_exported(spark, d):
    """L1 + L2 on the export."""
    return repos.top_exported(_export(spark, d), 10)


@register("repo_metadata_report")
def q_metadata_report(spark, d):
    """Q3 + A20 + F8."""
    return repos.metadata_report(fx.baseline(spark, d), fx.repository(spark, d), _export(spark, d))


def queries() -> dict[str, Query]:
    _load_more()
    return dict(QUERIES)


def _load_more() -> None:
    # modules that register further queries on import
    from pullscope.plans import registry_flow, registry_more  # noqa: F401
