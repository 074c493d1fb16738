"""The collection flow on landed inputs (the reference fetched them over HTTP and git).

payloads/git text -> ``pull_requests`` -> ``commits`` -> ``commit_details``; each step is a
lazy DataFrame. ``run_collect`` writes the five tables (K1) and returns the manifest (K9).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from pullscope.functions.scalars import packed_sha, unpacked_sha
from pullscope.operators.details import (assemble_details, attach_patch, attach_status, commit_totals,
                                         expand_to_prs)
from pullscope.operators.labels import (attach_repo_id, filter_created, label_author, repo_id_dim,
                                        target_repos, user_agent_dim)
from pullscope.sources.gittext import details_from_log, log_shas, patches_from_diff, statuses_from_listing
from pullscope.sources.payloads import detail_shas, details_from_json, line_sha, pull_requests_from_json


def pull_requests_from_payloads(raw: DataFrame, repos: DataFrame, agent_baseline: DataFrame,
                                date_from: str, date_to: str,
                                baseline_order: str = "id", only_targets: bool = False
                                ) -> tuple[DataFrame, DataFrame]:
    """S6 -> F2 -> J3 -> J2: PR payloads to the labelled PR table, plus the error keys.

    With ``only_targets`` PRs are taken from, and names mapped to ids over, the repositories that hold an
    agent PR of the baseline (J1), as a collection that lists only those does. ``baseline_order``
    may be the stored row order (``sources.tables.with_stored_order``).
    """
    rows, errors = pull_requests_from_json(raw)
    if only_targets:
        repos = target_repos(repos, agent_baseline)
        names = repos.select(F.col("full_name").alias("repo_name")).where("repo_name is not null").distinct()
        rows = rows.join(names, "repo_name", "left_semi")
    prs = filter_created(rows, date_from, date_to)
    prs = attach_repo_id(prs, repo_id_dim(repos))
    prs = label_author(prs, user_agent_dim(agent_baseline, baseline_order))
    return prs, errors


def retry_pull_requests(second: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The one retry pass. ``second`` holds the lines delivered when the listings were asked for
    again; only repositories among the error keys are taken. Returns their rows and what still fails.
    """
    rows, still = pull_requests_from_json(second)
    keys = errors.where(F.col("kind").isin("page_failed", "no_id")).select(F.col("key").alias("repo_name")).distinct()
    failing = still.join(keys.withColumnRenamed("repo_name", "key"), "key", "left_semi")
    return rows.join(keys, "repo_name", "left_semi"), failing


def details_from_git(log_docs: DataFrame, status_docs: DataFrame, diff_docs: DataFrame | None,
                     bridge: DataFrame, shas: DataFrame | None = None) -> DataFrame:
    """S9 + S10 (J14) + S11 (J15) + A5 + J12: git text to ``commit_details``.

    The numstat rows are joined with statuses on (sha, filename); patches are attached last so
    the 1 MB texts are not carried through the status join. ``shas`` restricts every parsed
    source to those commits (semi-joins) before any of the joins. All of it goes by packed shas.
    """
    kept = None if shas is None else _packed_keys(shas)

    def keep(df: DataFrame) -> DataFrame:
        return df if kept is None else df.join(kept, "sha", "left_semi")

    rows = attach_status(keep(details_from_log(log_docs, packed=True)), keep(statuses_from_listing(status_docs, packed=True)))
    if diff_docs is not None:
        rows = attach_patch(rows, keep(patches_from_diff(diff_docs, packed=True)))
    return assemble_details(rows, bridge)


def _packed_keys(rows: DataFrame) -> DataFrame:
    """The shas of ``rows``, packed if they are not."""
    return rows.select("sha" if isinstance(rows.schema["sha"].dataType, BinaryType) else packed_sha("sha").alias("sha"))


def details_git_or_api(log_docs: DataFrame, status_docs: DataFrame, diff_docs: DataFrame, api_lines: DataFrame,
                       bridge: DataFrame, shas: DataFrame) -> DataFrame:
    """J16 as one flow: commits of ``shas`` found in the git text, the payloads for the rest; rows with
    ``detail_source`` (git / api).

    Every source is dealt by packed sha once, and all joins take the rows where they lie: nothing is written between.
    Payload lines of commits found in git are dropped by their sha before they are parsed; patches of the git text are
    attached after the fan-out, a payload's files have theirs.
    """
    from pullscope.schemas import COMMIT_DETAILS
    keep, bridge = _packed_keys(shas), bridge.withColumn("sha", packed_sha("sha"))
    log = details_from_log(log_docs, packed=True).join(keep, "sha", "left_semi")
    git = commit_totals(attach_status(log, statuses_from_listing(status_docs, packed=True).join(keep, "sha", "left_semi")))
    found = log_shas(log_docs, packed=True).join(keep, "sha", "left_semi")
    git = attach_patch(expand_to_prs(git, bridge), patches_from_diff(diff_docs, packed=True))
    api = expand_to_prs(details_from_json(_lines_without(api_lines, found), key="sha"), bridge)
    rows = git.withColumn("detail_source", F.lit("git")).unionByName(api.withColumn("detail_source", F.lit("api")))
    rows = rows.withColumn("changes", (F.col("additions") + F.col("deletions")).cast("long")).withColumn("sha", unpacked_sha("sha"))
    return rows.select(*[F.col(c.name).cast(c.dataType) for c in COMMIT_DETAILS.fields], "detail_source")


def missing_details(log_docs: DataFrame, api_lines: DataFrame, bridge: DataFrame, shas: DataFrame) -> DataFrame:
    """Q4: shas of the bridge that neither source of ``details_git_or_api`` holds. Of the git text only the blocks'
    headers are read, of the payloads only their shas; no file row is made.

    One aggregate by packed sha tells where each is. A payload line that is dropped there, as git holds its commit, counts here: its
    commit is not missing either way.
    """
    in_bridge, in_log, wanted, in_api = 1, 2, 4, 8
    seen = [(_packed_keys(bridge), in_bridge), (log_shas(log_docs, packed=True, distinct=False), in_log), (_packed_keys(shas), wanted),
            (_packed_keys(detail_shas(api_lines, distinct=False)), in_api)]
    rows = reduce(DataFrame.unionByName, [df.select("sha", F.lit(place).alias("place")) for df, place in seen])
    places = rows.groupBy("sha").agg(F.bit_or("place").alias("p"))
    at = lambda *kinds: F.col("p").bitwiseAND(sum(kinds)) == sum(kinds)
    return places.where(at(in_bridge) & ~at(in_log, wanted) & ~at(in_api)).select(unpacked_sha("sha").alias("sha"))


def _lines_without(api_lines: DataFrame, found: DataFrame) -> DataFrame:
    """Payload lines whose sha is not among the packed ones of ``found``, with it."""
    return api_lines.select("value", packed_sha(line_sha()).alias("sha")).join(found.select("sha"), "sha", "left_anti")


def split_by_agent(prs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """the agent and human PR tables of the collector's output."""
    return prs.where(F.col("is_agent")), prs.where(~F.col("is_agent"))


def run_collect(prs: DataFrame, commits: DataFrame, details: DataFrame, out_dir: str) -> DataFrame:
    """K1 + K9: write all_pull_requests, agent/human subsets, pr_commits, pr_commit_details and
    return the manifest (rows and columns per table)."""
    from pullscope.sources.sinks import manifest, write_table
    tables = {"all_pull_requests": prs, "pr_commits": commits, "pr_commit_details": details}
    # the PR table is written first and its subsets are made from what was written
    write_table(prs, f"{out_dir}/all_pull_requests")
    agent, human = split_by_agent(prs.sparkSession.read.parquet(f"{out_dir}/all_pull_requests"))
    tables |= {"agent_pull_requests": agent, "human_pull_requests": human}
    for name in list(tables)[1:]:
        write_table(tables[name], f"{out_dir}/{name}")
    return manifest(prs.sparkSession, {n: f"{out_dir}/{n}" for n in tables})
