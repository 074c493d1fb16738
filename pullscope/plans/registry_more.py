"""Further registered queries: payload and git-text sources, detail assembly, quality,
sampling and streaming. Imported by ``registry.queries()``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pullscope.functions.scalars import packed_sha
from pullscope.operators import details as det
from pullscope.operators import labels, quality, sampling, stats
from pullscope.operators import facts
from pullscope.plans.classify import Classified, write_classified
from pullscope.plans.collect import (details_from_git, details_git_or_api, missing_details,
                                     pull_requests_from_payloads, retry_pull_requests, run_collect)
from pullscope.plans.export import export_repos, write_export
from pullscope.plans.registry import _fix, register
from pullscope.sources import fixtures as fx
from pullscope.sources import landed, tables
from pullscope.sources.payloads import (commits_from_json, details_from_json,
                                        pull_requests_from_json)

PR_OUT = ["id", "number", "title", "user", "user_id", "state", "created_at", "closed_at",
          "merged_at", "repo_id", "repo_url", "repo_name", "html_url", "is_agent", "agent"]


# ---- S6-S8 ---------------------------------------------------------------------------------
@register("prs_from_json")
def q_prs_from_json(spark, d):
    """S6 + H14 + F2 + J2 + J3: PR payloads -> the collector's PR table."""
    prs, _errors = pull_requests_from_payloads(
        landed.pr_payloads(spark, d), fx.repository(spark, d),
        labels.filter_agents(fx.baseline(spark, d)), fx.WINDOW_FROM, fx.WINDOW_TO)
    return prs.select(*PR_OUT)


@register("target_repo_prs")
def q_target_repo_prs(spark, d):
    """J1 in the PR flow: PRs of repositories that hold an agent PR, ids mapped over those only."""
    prs, _errors = pull_requests_from_payloads(
        landed.pr_payloads(spark, d), fx.repository(spark, d),
        labels.filter_agents(fx.baseline(spark, d)), fx.WINDOW_FROM, fx.WINDOW_TO, only_targets=True)
    return prs.select("id", "repo_name", "repo_id")


@register("commits_from_json")
def q_commits_from_json(spark, d):
    """S7 + S14 + H13: commit-list pages -> commits with stored order."""
    rows, _errors = commits_from_json(landed.commit_payloads(spark, d))
    return rows


@register("commit_errors")
def q_commit_errors(spark, d):
    """S7 + S14: PRs voided by a failed page or without commits, and malformed lines."""
    _rows, errors = commits_from_json(landed.commit_payloads(spark, d))
    return errors


@register("pr_errors")
def q_pr_errors(spark, d):
    """S6 + Q6: repositories with a failed page, malformed lines, elements without an id."""
    _rows, errors = pull_requests_from_json(landed.pr_payloads(spark, d))
    return errors


@register("unmatched_shas")
def q_unmatched(spark, d):
    """Q4: shas of which no PR has a known repository (``sha_repo``'s second output)."""
    _m, unmatched = det.sha_repo(fx.commits(spark, d), fx.known_prs(spark, d))
    return unmatched


@register("details_from_json")
def q_details_from_json(spark, d):
    """S8 + J12: commit-detail payloads -> commit_details (API form, with patch)."""
    files = details_from_json(landed.detail_payloads(spark, d)).withColumn("sha", packed_sha("sha"))
    return det.assemble_details(files, fx.commits(spark, d).select("sha", "pr_id"))


@register("details_from_git_text")
def q_details_from_git(spark, d):
    """S9 + S10 + S11 + J14 + J15 + A5 + J12: git text -> commit_details (with patch)."""
    log, status, diff = landed.git_docs(spark, d)
    return details_from_git(log, status, diff, fx.commits(spark, d).select("sha", "pr_id"))


def _local_shas(spark, d):
    """Packed shas of the commits of suppliers with a non-negative balance: those that the local clone holds."""
    sup = fx.table(spark, d, "supplier").where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey"))
    return (fx.table(spark, d, "lineitem").join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
            .select(packed_sha(F.sha1(F.concat(F.lit("c"), F.col("l_partkey").cast("string"), F.lit("-"),
                                               F.col("l_suppkey").cast("string")))).alias("sha")))


@register("details_prefer_git")
def q_details_prefer(spark, d):
    """J16 + J12 + J14 + J15: git rows where the commit is in the local clone, API rows for the rest,
    each marked with its source."""
    log, status, diff = landed.git_docs(spark, d)
    return details_git_or_api(log, status, diff, landed.detail_payloads(spark, d),
                              fx.commits(spark, d).select("sha", "pr_id"), _local_shas(spark, d))


@register("missing_shas")
def q_missing_shas(spark, d):
    """Q4: commits found in neither source."""
    return missing_details(landed.git_log(spark, d), landed.detail_payloads(spark, d), fx.commits(spark, d).select("sha", "pr_id"), _local_shas(spark, d))


@register("detail_errors")
def q_detail_errors(spark, d):
    """S8 + Q6: detail lines that are malformed, with their text, or lack a sha (commit-list lines read as details)."""
    from pullscope.sources.payloads import detail_errors
    return detail_errors(landed.commit_payloads(spark, d)).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("lines"))


@register("sha_repo")
def q_sha_repo(spark, d):
    """Repository of each sha (first PR in commits order with a known repository)."""
    m, _unmatched = det.sha_repo(fx.commits(spark, d), fx.raw_prs(spark, d))
    return m


@register("sha_batches")
def q_sha_batches(spark, d):
    """The shas of every repository in batches of about two: shas, batches at most, and whether every sha has one of them."""
    m, _unmatched = det.sha_repo(fx.commits(spark, d), fx.raw_prs(spark, d))
    b = det.batch_keys(m, batch_size=2)
    most = F.ceil(F.count(F.lit(1)) / 2)
    return b.groupBy("repo_name").agg(F.count(F.lit(1)).alias("shas"), most.alias("batches"),
                                      ((F.min("batch") >= 0) & (F.max("batch") < most)).alias("within"))


# ---- chunks, state, retry ------------------------------------------------------------------
@register("chunks_merged")
def q_chunks(spark, d):
    """K2 + K3 + S5: PRs written to the chunk store by repository, merged into one table, read back."""
    from pullscope.schemas import PULL_REQUESTS
    from pullscope.sources.chunks import merge_chunks, write_chunks
    base = _landing(spark, "chunks")
    write_chunks(fx.pull_requests(spark, d), f"{base}/chunks")
    merge_chunks(spark, f"{base}/chunks", f"{base}/table", PULL_REQUESTS)
    return spark.read.parquet(f"{base}/table").select("id", "repo_name", "title", "agent")


@register("state_remaining")
def q_state(spark, d):
    """K7 + S12 + J10 + J11: repositories saved as done or failed; of all, how many remain and how many are
    tried again. An older state with other keys must not count."""
    from pullscope.sources import state as st
    base = _landing(spark, "state")
    repos = fx.raw_prs(spark, d).groupBy("repo_name").agg(F.min("user_id").alias("u"))
    row = lambda kind: [F.lit("prs").alias("phase"), F.col("repo_name").alias("key"), F.lit(kind).alias("kind"),
                        F.lit(None).cast("string").alias("detail"), F.lit("").alias("run_id")]
    st.write_state(repos.select(*row("done")), base, "1")
    done, failed = repos.where(F.col("u") % 3 == 0).select(*row("done")), repos.where(F.col("u") % 5 == 1).select(*row("error"))
    st.write_state(done.unionByName(failed), base, "2")
    saved, keys = st.read_state(spark, base), repos.select(F.col("repo_name").alias("key"))
    return (st.remaining(keys, saved).select(F.lit("remaining").alias("kind"), "key")
            .unionByName(st.retry_set(keys, saved).select(F.lit("retry").alias("kind"), "key")))


@register("retry_prs")
def q_retry(spark, d):
    """Repositories whose first listing had a failed page, listed again; rows of the second delivery."""
    first = landed.pr_payloads(spark, d)
    _rows, errors = pull_requests_from_json(first)
    again, _still = retry_pull_requests(first.where(~F.col("value").contains('"page_failed":true')), errors)
    return again.select("id", "repo_name", "state")


@register("capped_patches")
def q_capped(spark, d):
    """S11 + H12: patches under an explicit cap of 18 bytes; longer ones are null and marked."""
    from pullscope.sources.gittext import patches_from_diff
    return patches_from_diff(landed.git_diff(spark, d), max_bytes=18, flag_capped=True)


@register("repo_slugs")
def q_slugs(spark, d):
    """File-name form of every repository name, with its number of PRs."""
    from pullscope.functions.scalars import repo_slug
    return fx.raw_prs(spark, d).groupBy(repo_slug("repo_name").alias("slug")).agg(F.count(F.lit(1)).alias("prs"))


@register("first_prs")
def q_first(spark, d):
    """L3: the first ten PRs in stored order of a table written sorted by id."""
    base = _landing(spark, "first")
    fx.raw_prs(spark, d).repartitionByRange("id").sortWithinPartitions("id").write.parquet(base)
    return sampling.head_in_order(tables.with_stored_order(spark.read.parquet(base)), 10).select("id", "title", "repo_name")


# ---- written flows -------------------------------------------------------------------------
def _collected(spark, d) -> tuple:
    base = _landing(spark, "collect")
    manifest = run_collect(fx.pull_requests(spark, d), fx.commits(spark, d), fx.commit_details(spark, d), base)
    return base, manifest


@register("collect_manifest")
def q_collect(spark, d):
    """K1 + K9 + F4: the collector's five tables written, and their rows from the manifest."""
    return _collected(spark, d)[1].select("table", "rows")


@register("classified_from_files")
def q_classified_files(spark, d):
    """S4 + U1 + F10 + K1: the written agent and human tables read back, labelled, united, written, and the fix
    PRs read from there."""
    base, _manifest = _collected(spark, d)
    agent, human = (tables.read_table(spark, f"{base}/{n}_pull_requests") for n in ("agent", "human"))
    united = labels.classify_prs(agent, human)
    write_classified(Classified(united, labels.fix_only(united), None, None), f"{base}/classified")
    return tables.read_table(spark, f"{base}/classified/fix_prs_only", columns=["id", "type", "source"])


@register("labels_in_stored_order")
def q_labels_stored(spark, d):
    """S2 + J2 in row order: the baseline written with descending ids, so that a user's last label is another
    one than in id order."""
    base = _landing(spark, "baseline")
    fx.baseline(spark, d).repartitionByRange(F.desc("id")).sortWithinPartitions(F.desc("id")).write.parquet(base)
    stored = tables.with_stored_order(spark.read.parquet(base))
    dim = labels.user_agent_dim(labels.filter_agents(stored), "row_ord")
    users = tables.read_baseline(spark, base, columns=("user",)).distinct()
    return users.join(dim, "user").select("user", F.col("_label").alias("agent"))


@register("export_csv")
def q_export_csv(spark, d):
    """L1 + K5 + Q3: the export written as CSV and read back."""
    base = _landing(spark, "export")
    write_export(export_repos(fx.baseline(spark, d), fx.repository(spark, d)), base)
    return (spark.read.option("header", True).csv(base)
            .select("repository", F.col("pr_count").cast("long").alias("pr_count"),
                    F.col("in_repository_metadata").cast("boolean").alias("in_repository_metadata")))


# ---- quality, sampling, shapes -------------------------------------------------------------
@register("validation_month")
def q_validation_month(spark, d):
    """Q1 + A20: one-month slice against the baseline (January 1997)."""
    prs = fx.pull_requests(spark, d)
    return quality.validate_month(prs, labels.filter_agents(fx.baseline(spark, d)),
                                  "1997-01-01", "1997-01-31")


@register("sample_prs")
def q_sample_prs(spark, d):
    """L4: 20 PRs chosen by seeded hash order (same rows on any cluster)."""
    return sampling.sample_n(fx.pull_requests(spark, d).drop("body"), 20, 42, ["id"])


@register("violin_lines_added")
def q_violin_added(spark, d):
    """log10 density of lines added per PR, agent vs human, 100-point grid + box."""
    r = _fix(spark, d)
    pst = facts.attach_source(facts.change_size(r.fix_details), r.fix_prs)
    return stats.violin(pst, "lines_added", "source", log=True)


def _register_violins() -> None:
    """The other log-scaled shapes of the report (change size and revision size)."""
    def change(metric):
        def q(spark, d):
            r = _fix(spark, d)
            pst = facts.attach_source(facts.change_size(r.fix_details), r.fix_prs)
            return stats.violin(pst, metric, "source", log=True)
        return q

    def revision(metric):
        def q(spark, d):
            from pullscope.operators import revisions
            r = _fix(spark, d)
            rev = facts.revised_prs(r.fix_prs, r.fix_commits)
            sizes = revisions.revision_size_by(rev.select("pr_id", "source"), r.fix_commits, r.fix_details)
            return stats.violin(sizes, metric, "source", log=True)
        return q

    for m in ("files_changed", "lines_deleted"):
        register(f"violin_{m}")(change(m))
    for m in ("rev_files_changed", "rev_lines_added", "rev_lines_deleted"):
        register(f"violin_{m}")(revision(m))


_register_violins()


@register("mann_whitney_exact")
def q_mann_whitney_exact(spark, d):
    """A22, exact branch: balances summed by nation, five nations of one region against the rest."""
    c = fx.table(spark, d, "customer").groupBy("c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(20,2)")).alias("v"))
    n = fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey"))
    v = c.join(n, "c_nationkey").select((F.col("v") * 100).cast("long").alias("v"),
                                        F.when(F.col("n_regionkey") == 0, "agent").otherwise("human").alias("source"))
    return stats.mann_whitney(v, "v", method="auto").drop("has_ties")


@register("mann_whitney_tied")
def q_mann_whitney_tied(spark, d):
    """A22 without spread: every merged PR counts as one, so p is 1."""
    prs = fx.pull_requests(spark, d).where(F.col("merged_at").isNotNull())
    one = prs.select(F.lit(1).alias("v"), F.when(F.col("is_agent"), "agent").otherwise("human").alias("source"))
    return stats.mann_whitney(one, "v").drop("has_ties")


@register("violin_revisions")
def q_violin_revisions(spark, d):
    """Linear density of commit counts of revised PRs, clipped at min(max, 50)."""
    r = _fix(spark, d, with_details=False)
    rev = facts.revised_prs(r.fix_prs, r.fix_commits)
    return stats.violin(rev, "num_commits", "source", log=False, clip_upper=50)


# ---- streaming -----------------------------------------------------------------------------
def _landing(spark, name: str) -> str:
    import uuid
    from pullscope.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("ingest_stream_prs")
def q_ingest_stream(spark, d):
    """T1-T4 + T7: PR payload files streamed (availableNow) -> labelled, classified PRs."""
    from pullscope.streaming.ingest import ingest_prs
    base = _landing(spark, "ingest")
    dim = labels.user_agent_dim(labels.filter_agents(fx.baseline(spark, d)))
    q = ingest_prs(spark, landed.pr_payload_path(spark, d), dim, f"{base}/out", f"{base}/ckpt", max_files=2, form="parquet")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return labels.filter_created(out, fx.WINDOW_FROM, fx.WINDOW_TO).select(
        "id", "title", "user", "created_at", "merged_at", "is_agent", "agent", "type", "source")


@register("volume_stream_daily")
def q_volume_stream(spark, d):
    """Daily PR volume per source from the stream, equal to the batch count."""
    from pullscope.streaming.ingest import volume_stream, volume_table
    base = _landing(spark, "volume")
    dim = labels.user_agent_dim(labels.filter_agents(fx.baseline(spark, d)))
    q = volume_stream(spark, landed.pr_payload_path(spark, d), dim, f"{base}/out", f"{base}/ckpt", max_files=2, form="parquet")
    q.awaitTermination()
    return volume_table(spark, f"{base}/out")


# ---- report (K8 numbers) -------------------------------------------------------------------
@register("report_table")
def q_report_table(spark, d):
    """The whole report as one long table (section, grp, metric, value)."""
    from pullscope.plans.report import build_report
    r = _fix(spark, d, with_body=True)
    return build_report(r.fix_prs, r.fix_commits, r.fix_details, commits=fx.commits(spark, d), details=fx.commit_details(spark, d))


@register("events_type_volume_stream")
def q_events_stream(spark, d):
    """T8 + H1: the driver's event table as a file stream; daily counts of fix-like events."""
    from pullscope.streaming.ingest import event_volume_stream, event_volume_table
    base = _landing(spark, "events")
    q = event_volume_stream(spark, f"{d}/events*.parquet", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return event_volume_table(spark, f"{base}/out")
