"""Registered queries of incremental flows: chunk store, streams with keyed state, ordered lists,
clustered tables, git output as bytes, SQL functions, report text and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from pullscope.functions.scalars import packed_sha, unpacked_sha
from pullscope.operators import labels, quality
from pullscope.operators.bridges import ordered_lists
from pullscope.plans.collect import details_from_git
from pullscope.plans.registry import _fix, register, round_doubles
from pullscope.plans.registry_more import _collected, _landing
from pullscope.schemas import COMMIT_DETAILS, PULL_REQUESTS
from pullscope.sources import chunks, gitbytes, landed, sinks, tables
from pullscope.sources import fixtures as fx
from pullscope.streaming import ingest


# ---- chunk store ---------------------------------------------------------------------------
def rewritten(prs, key: str = "user_id"):
    """A second collection of some repositories: of one in 499 the titles changed, of one in 997 nothing is left."""
    again = prs.where(F.col(key) % 499 == 3)
    gone = prs.where(F.col(key) % 997 == 5)
    new = again.where(F.col(key) % 997 != 5).withColumn("title", F.concat(F.lit("Again: "), F.coalesce("title", F.lit(""))))
    return new, again.select("repo_name").unionByName(gone.select("repo_name"))


@register("chunks_rewritten")
def q_chunks_rewritten(spark, d):
    """K2 + K3 + S5 + B15: all repositories collected and merged, some of them again with other rows or none, merged again: the
    second merge reads the changed buckets, and no stale row is left."""
    base, prs = _landing(spark, "rechunked"), fx.pull_requests(spark, d)
    chunks.write_chunks(prs, f"{base}/chunks", buckets=64)
    chunks.merge_chunks(spark, f"{base}/chunks", f"{base}/table", PULL_REQUESTS)
    new, keys = rewritten(prs)
    chunks.write_chunks(new, f"{base}/chunks", keys=keys)
    chunks.merge_chunks(spark, f"{base}/chunks", f"{base}/table", PULL_REQUESTS)
    return chunks.read_merged(spark, f"{base}/table", PULL_REQUESTS).select("id", "repo_name", "title", "agent")


@register("chunks_current")
def q_chunks_current(spark, d):
    """The store itself after a rewrite, read without a merge; PRs and repositories per agent."""
    base, prs = _landing(spark, "current"), fx.pull_requests(spark, d)
    chunks.write_chunks(prs, f"{base}/chunks")
    new, keys = rewritten(prs)
    chunks.write_chunks(new, f"{base}/chunks", keys=keys)
    rows = chunks.read_chunks(spark, f"{base}/chunks", PULL_REQUESTS)
    return rows.groupBy("agent").agg(F.count(F.lit(1)).alias("prs"), F.countDistinct("repo_name").alias("repos"))


# ---- streams with keyed state --------------------------------------------------------------
def _dim(spark, d):
    return labels.user_agent_dim(labels.filter_agents(fx.baseline(spark, d)))


def _line(p, title, created):
    """A PR-list element as a landed line."""
    user = F.struct(p["user"].alias("login"), p["user_id"].alias("id")).alias("user")
    return F.to_json(F.struct(p["repo_name"].alias("repo"), p["id"], p["number"], title.alias("title"), user, p["state"],
                              created.alias("created_at"), p["closed_at"], p["merged_at"], p["html_url"])).alias("value")


def _land(lines, folder: str) -> None:
    lines.write.mode("append").parquet(folder)


@register("ingest_redelivered")
def q_ingest_redelivered(spark, d):
    """T4: ids delivered again with another title and month, in the batch of the first copy and in a later one. The copy
    that was landed first stays."""
    base, p = _landing(spark, "again"), fx.raw_prs(spark, d)
    same, other = _line(p, p["title"], p["created_at"]), _line(p, F.lit("Fix: other copy"), F.lit("2001-02-03T04:05:06Z"))
    _land(p.where("id % 3 <> 0").select(same), f"{base}/land")
    _land(p.where("id % 7 = 0").select(other), f"{base}/land")
    run = lambda: ingest.ingest_prs(spark, f"{base}/land", _dim(spark, d), f"{base}/out", f"{base}/ckpt", max_files=1000,
                                    form="parquet").awaitTermination()
    run()
    _land(p.where("id % 3 = 0").select(same).unionByName(p.where("id % 5 = 0 and id % 3 <> 0").select(other)), f"{base}/land")
    run()
    return spark.read.parquet(f"{base}/out").select("id", "title", "created_at", "agent", "type")


class Stopped(Exception):
    """What a test or query raises to stop a stream between writing a batch and committing it."""


def interrupted_ingest(spark, d, base: str) -> None:
    """The PR payloads landed in two parts; the first run dies after writing its second batch, a later run
    resumes from the checkpoint when the other part is there."""
    lines = landed.pr_payloads(spark, d)
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    _land(lines.where(part == 0).repartition(4), f"{base}/land")

    def stop(batch_id: int) -> None:
        if batch_id == 1:
            raise Stopped("stopped before the commit of batch 1")

    start = lambda files, hook: ingest.ingest_prs(spark, f"{base}/land", _dim(spark, d), f"{base}/out", f"{base}/ckpt",
                                                  max_files=files, form="parquet", after_batch=hook)
    from pyspark.errors import StreamingQueryException
    try:
        start(2, stop).awaitTermination()
    except StreamingQueryException:
        pass
    _land(lines.where(part == 1), f"{base}/land")
    start(1000, None).awaitTermination()


@register("ingest_resumed")
def q_ingest_resumed(spark, d):
    """A run that dies between writing and committing a batch, files landed meanwhile, and a second run from the checkpoint
    that replays the batch; the rows equal those of one uninterrupted batch."""
    base = _landing(spark, "resumed")
    interrupted_ingest(spark, d, base)
    return spark.read.parquet(f"{base}/out").select("id", "title", "user", "created_at", "merged_at", "is_agent", "agent", "type")


def _streamed(spark, d) -> str:
    base = _landing(spark, "streamed")
    ingest.ingest_prs(spark, landed.pr_payload_path(spark, d), _dim(spark, d), f"{base}/out", f"{base}/ckpt", max_files=1000,
                      form="parquet").awaitTermination()
    return f"{base}/out"


@register("stream_dead_letters")
def q_stream_dead(spark, d):
    """T3 + Q6: lines that gave no row (cut-off lines, failed pages, answers without an id), written with the rows by the
    same batch function."""
    return ingest.dead_letters(spark, _streamed(spark, d))


@register("stream_retry")
def q_stream_retry(spark, d):
    """Repositories among a stream's dead letters, delivered once more: their rows, and as ``still_failed`` those that fail again
    (every other failed page)."""
    out = _streamed(spark, d)
    again = landed.pr_payloads(spark, d).where(~F.col("value").contains('"page_failed":true') | F.col("value").contains('/repo1'))
    rows, still = ingest.retry_dead_letters(spark, out, again)
    failed = still.where("kind = 'page_failed'").select(F.col("key").alias("repo_name")).distinct()
    return (rows.groupBy("repo_name").agg(F.count(F.lit(1)).alias("prs"))
            .join(failed.withColumn("still_failed", F.lit(True)), "repo_name", "left")
            .select("repo_name", "prs", F.coalesce("still_failed", F.lit(False)).alias("still_failed")))


@register("stream_progress")
def q_stream_progress(spark, d):
    """T5 + H25: the last progress row of a streamed run: lines done of all, rows and dead letters written, and whether the
    rate per hour is that of its elapsed time."""
    out = _streamed(spark, d)
    total = landed.pr_payloads(spark, d).count()
    p = ingest.progress_table(spark, out, total)
    return p.groupBy("phase").agg(F.max("done").alias("done"), F.max("total").alias("total"), F.sum("written_rows").alias("written_rows"),
                                  F.sum("dead_rows").alias("dead_rows"), F.bool_and(F.col("rate_per_hour") > 0).alias("has_rate"))


# ---- A19 -----------------------------------------------------------------------------------
def _pages(lists, key: str):
    return lists.select(key, "page", F.size("items").alias("n"),
                        F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


@register("sha_pr_lists")
def q_sha_lists(spark, d):
    """The PR ids of every sha in commits order, in pages of at most 1000."""
    cm = fx.commits(spark, d).withColumn("sha", packed_sha("sha"))
    lists = ordered_lists(cm, "sha", ["pr_id", "commit_seq"], "pr_id")
    return _pages(lists.withColumn("sha", unpacked_sha("sha")), "sha")


@register("repo_sha_lists")
def q_repo_lists(spark, d):
    """A19 + J13: the shas of every repository, by the first PR that holds them; pages of at most five, so that lists have several."""
    from pullscope.operators.details import sha_repo
    cm = fx.commits(spark, d).withColumn("sha", packed_sha("sha"))
    m, _unmatched = sha_repo(cm, fx.raw_prs(spark, d))
    first = cm.groupBy("sha").agg(F.min(F.struct("pr_id", "commit_seq")).alias("f")).select("sha", "f.*")
    lists = ordered_lists(m.join(first, "sha"), "repo_name", ["pr_id", "commit_seq", "sha"], "sha", page_rows=5)
    return _pages(lists.withColumn("items", F.transform("items", unpacked_sha)), "repo_name")


# ---- F3 ------------------------------------------------------------------------------------
@register("window_from_clustered")
def q_window_clustered(spark, d):
    """F3 + K1: the PR table written clustered by creation time and read with the collection window; files and row
    groups outside the window are skipped by their statistics."""
    base = _landing(spark, "clustered")
    sinks.write_table(fx.raw_prs(spark, d), base, sort_by="created_at", row_group_bytes=1 << 16)
    return labels.filter_created(spark.read.parquet(base), fx.WINDOW_FROM, fx.WINDOW_TO).select("id", "created_at", "repo_name")


# ---- git output as bytes -------------------------------------------------------------------
def _land_bytes(docs, folder: str) -> None:
    """Documents as files of raw lines, authors with a byte that is no UTF-8."""
    raw = F.concat(F.lit("D"), F.unhex(F.lit("FF")).cast("string"), F.lit("v Name "))
    docs.select(F.replace("text", F.lit("Dev Name "), raw).alias("value")).write.text(folder)


@register("details_from_bytes")
def q_details_from_bytes(spark, d):
    """S9 + S10 + H23 + W3 + A5 + J12 from bytes: the commit log and the name-status listing landed as raw files, read by lines,
    put together to records and parsed."""
    base = _landing(spark, "bytes")
    log, status = landed.git_log(spark, d), landed.git_status(spark, d)
    older = F.col("doc_id").startswith("!")  # the copies that were landed first
    _land_bytes(log.where(older), f"{base}/log/1-older")
    _land_bytes(log.where(~older), f"{base}/log/2-newer")
    _land_bytes(status, f"{base}/status")
    log_docs = gitbytes.log_records(gitbytes.read_landed_lines(spark, f"{base}/log/*"))
    status_docs = gitbytes.listing_records(gitbytes.read_landed_lines(spark, f"{base}/status"))
    rows = details_from_git(log_docs, status_docs, None, fx.commits(spark, d).select("sha", "pr_id"))
    return rows.select(*[c for c in COMMIT_DETAILS.names if c != "patch"])


@register("patches_from_bytes")
def q_patches_from_bytes(spark, d):
    """S11 + H22 + H23 from bytes: the diffs of all commits in a few files, a sha line before each, cut into one document per file."""
    from pullscope.sources.gittext import patches_from_diff
    base = _landing(spark, "diffs")
    landed.git_diff(spark, d).select(F.concat("sha", F.lit("\n"), F.rtrim("text", F.lit("\n"))).alias("value")).write.text(f"{base}/diff")
    docs = gitbytes.diff_records(gitbytes.read_landed_lines(spark, f"{base}/diff"))
    return patches_from_diff(docs, packed=True).withColumn("sha", unpacked_sha("sha"))


# ---- SQL -----------------------------------------------------------------------------------
@register("sql_row_functions")
def q_sql_functions(spark, d):
    """2.11: H1-H5 as SQL functions, in a query written in SQL."""
    from pullscope.functions.sql import register_sql_functions
    register_sql_functions(spark)
    return spark.sql("""
        SELECT p.id, classify_title(p.title) AS type, repo_from_url(p.html_url) AS repo, clean_url(p.html_url) AS url,
               final_name(CASE p.id % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN p.repo_name END, p.html_url, NULL) AS name,
               word_count(p.title) AS words
        FROM {prs} p""", prs=fx.raw_prs(spark, d))


# ---- report text, samples, manifest, guards ------------------------------------------------
@register("report_text")
def q_report_text(spark, d):
    """K8 + H18: the report written, and its text lines read back."""
    from pullscope.plans.report import build_report, with_text
    base = _landing(spark, "report")
    r = _fix(spark, d, with_body=True)
    report = build_report(r.fix_prs, r.fix_commits, r.fix_details, commits=fx.commits(spark, d), details=fx.commit_details(spark, d))
    sinks.write_report(with_text(round_doubles(report)), base)
    return spark.read.text(f"{base}/text").select(F.col("value").alias("line"))


@register("samples_csv")
def q_samples_csv(spark, d):
    """K6 + L4: samples of two tables written as CSV and read back."""
    base = _landing(spark, "samples")
    prs, cm = fx.pull_requests(spark, d).drop("body"), fx.commits(spark, d)
    sinks.write_samples({"pull_requests": prs, "commits": cm}, base, keys={"pull_requests": ["id"], "commits": ["sha", "pr_id", "commit_seq"]})
    back = lambda name: spark.read.option("header", True).csv(f"{base}/{name}_sample")
    return (back("pull_requests").select(F.lit("pull_requests").alias("table"), F.col("id").alias("key"), F.col("title").alias("value"))
            .unionByName(back("commits").select(F.lit("commits").alias("table"), F.col("sha").alias("key"), F.col("pr_id").alias("value"))))


@register("manifest_columns")
def q_manifest_columns(spark, d):
    """K9: rows and columns of every written table, and whether the rows of its files add up and have bytes."""
    base, _m = _collected(spark, d)
    paths = {n: f"{base}/{n}" for n in ("all_pull_requests", "agent_pull_requests", "human_pull_requests", "pr_commits", "pr_commit_details")}
    files = sinks.manifest_files(spark, paths).groupBy("table").agg(F.sum("rows").alias("file_rows"), F.bool_and(F.col("bytes") > 0).alias("sized"))
    return sinks.manifest(spark, paths).join(files, "table").select("table", "rows", "columns", "file_rows", "sized")


@register("conformance_nulls")
def q_conformance(spark, d):
    """Q2: columns of the written tables against the expected schemas, with their values and nulls; the human table is written
    without a body and with its number as text."""
    base, _m = _collected(spark, d)
    human = spark.read.parquet(f"{base}/human_pull_requests")
    other = human.drop("body").withColumn("number", F.col("number").cast("string"))
    sinks.write_table(other, f"{base}/other")
    read = {"agent": spark.read.parquet(f"{base}/agent_pull_requests"), "human": spark.read.parquet(f"{base}/other")}
    return quality.conformance(spark, read, {"agent": PULL_REQUESTS, "human": PULL_REQUESTS}, counts=True)


@register("optional_inputs")
def q_optional(spark, d):
    """S13 + Q5: the classification flow's optional details read where they are and skipped where they are not; the PRs are
    required, an empty table stops the flow."""
    base, _m = _collected(spark, d)
    out = []
    for name, path in (("present", f"{base}/pr_commit_details"), ("absent", f"{base}/no_details")):
        found = tables.read_optional(spark, path, COMMIT_DETAILS)
        rows = spark.createDataFrame([], "pr_id long") if found is None else found.select("pr_id")
        out.append(rows.agg(F.lit(name).alias("input"), F.lit("read" if found is not None else "skipped").alias("outcome"),
                            F.count(F.lit(1)).alias("rows"), F.countDistinct("pr_id").alias("prs")))
    prs = spark.read.parquet(f"{base}/all_pull_requests")
    for name, df in (("prs", prs), ("none", prs.where("id < 0"))):
        try:
            checked = quality.require_rows(df, name)
            out.append(checked.agg(F.lit(name).alias("input"), F.lit("rows").alias("outcome"), F.count(F.lit(1)).alias("rows"),
                                   F.countDistinct("id").alias("prs")))
        except ValueError as e:
            out.append(spark.createDataFrame([(name, str(e), 0, 0)], "input string, outcome string, rows long, prs long"))
    both = out[0]
    for more in out[1:]:
        both = both.unionByName(more)
    return both
