"""Landed payloads and git text made from the fixture tables (inputs of S6-S11).

The reference received these from the hosting API and from git child processes. For tests and
registered queries, Spark writes the same shapes from the fixture tables; parsing them back
must reproduce the fixture tables. Every group collected here is bounded: a page of at most
100 PR commits, the files of one commit, or one batch of about 500 commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.functions.scalars import STATUS_LETTERS, packed_sha, unpacked_sha
from pullscope.sources import fixtures as fx
from pullscope.sources.gittext import COMMIT_SEP, MSG_END
from pullscope.sources.payloads import PAGE_SIZE


#: How the payloads' authors and the shas they lack are told apart from the git text.
API_AUTHOR = "Api: "
UNKNOWN_SHA = "f"
#: Commits whose git output was landed twice: an older copy with other content comes first.
TWICE = "0"
#: Row groups of the PR lines: a stream takes a few files at a time, all cores read parts of them.
LANDED_GROUP_BYTES = 8 << 20


def _nl():
    return F.lit("\n")


def _pr_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR-list elements as JSON lines. ``merged_at`` travels in three forms: top level with no
    ``pull_request`` object, top level with an empty one, or inside ``pull_request``."""
    p = fx.raw_prs(spark, sf_dir)
    form = p.id % 3
    pr_obj = (F.when(form == 0, F.lit(None).cast("map<string,string>"))
              .when(form == 1, F.create_map().cast("map<string,string>"))
              .otherwise(F.create_map(F.lit("merged_at"), F.col("merged_at"),
                                      F.lit("url"), F.col("html_url"))))
    top_merged = F.when(form == 2, F.lit(None).cast("string")).otherwise(F.col("merged_at"))
    obj = F.struct(
        F.col("repo_name").alias("repo"), F.lit(1).alias("page"), F.lit(False).alias("page_failed"),
        "id", "number", "title", "body",
        F.struct(F.col("user").alias("login"), F.col("user_id").alias("id")).alias("user"),
        "state", "created_at", "closed_at", top_merged.alias("merged_at"), "html_url",
        pr_obj.alias("pull_request"))
    # what a listing also holds: failed pages, answers without an id, and cut-off lines; made with the line of their PR, so
    # that they lie in its file: streams read few whole files rather than many short ones
    failed = F.when(F.col("id") % 97 == 5, F.to_json(F.struct(
        F.col("repo_name").alias("repo"), F.lit(2).alias("page"), F.lit(True).alias("page_failed"))))
    no_id = F.when(F.col("id") % 89 == 7, F.to_json(F.struct(
        F.lit("Not Found").alias("message"), F.col("repo_name").alias("repo"))))
    lines = F.array_compact(F.array(F.to_json(obj), failed, no_id, _cut_line(83)))
    return p.select(F.explode(lines).alias("value"))


def _cut_line(every: int) -> F.Column:
    return F.when(F.col("id") % every == 3, F.concat(F.lit('{"id": '), F.col("id").cast("string")))


def _cut_lines(rows: DataFrame, every: int) -> DataFrame:
    return rows.select(_cut_line(every).alias("value")).where("value is not null")


def _commit_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-list pages (at most 100 commits each) as JSON lines."""
    c = fx.commits(spark, sf_dir).withColumn("sha", packed_sha("sha")).repartition("pr_id")  # pages are put together where their rows lie
    git_name = F.regexp_replace(F.col("author"), "^dev", "Dev Name ")
    no_login = F.col("author").startswith("Dev Name ")
    elem = F.struct(
        F.col("commit_seq").alias("seq"),
        F.struct(
            unpacked_sha("sha").alias("sha"),
            F.when(no_login, F.lit(None).cast("struct<login:string>"))
             .otherwise(F.struct(F.col("author").alias("login"))).alias("author"),
            F.struct(F.col("committer").alias("login")).alias("committer"),
            F.struct(F.col("message").alias("message"),
                     F.struct(git_name.alias("name")).alias("author"),
                     F.struct(F.lit("GitHub").alias("name")).alias("committer")).alias("commit"),
        ).alias("c"))
    page = (F.floor((F.col("commit_seq") - 1) / PAGE_SIZE) + 1).cast("int")
    g = c.groupBy("pr_id", page.alias("page")).agg(F.array_sort(F.collect_list(elem)).alias("_e"))
    obj = F.struct("pr_id", "page", F.lit(False).alias("page_failed"),
                   F.transform("_e", lambda e: e["c"]).alias("commits"))
    lines = g.select(F.to_json(obj).alias("value"))
    # a failed last page voids its PR; some PRs have no commits at all; some lines are cut off
    p = fx.raw_prs(spark, sf_dir)
    none = F.array().cast("array<string>").alias("commits")
    failed = g.select("pr_id").distinct().where(F.col("pr_id") % 101 == 3).select(F.to_json(F.struct(
        "pr_id", F.lit(99).alias("page"), F.lit(True).alias("page_failed"), none)).alias("value"))
    empty = p.where(F.col("id") % 103 == 4).select(F.to_json(F.struct(
        (-F.col("id")).alias("pr_id"), F.lit(1).alias("page"), F.lit(False).alias("page_failed"), none)).alias("value"))
    return lines.unionByName(failed).unionByName(empty).unionByName(_cut_lines(p, 107))


def _detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-detail objects (one per sha) as JSON lines; 'modified' files omit ``status``. Authors differ
    from the git form, and the interface does not know every sha."""
    g = fx.packed_commit_files(spark, sf_dir).where(~unpacked_sha("sha").startswith(UNKNOWN_SHA))
    total = lambda name: F.aggregate(f"files.{name}", F.lit(0).cast("long"), lambda t, n: t + n)
    g = g.select("sha", F.concat(F.lit(API_AUTHOR), F.col("author")).alias("author"), "committer", "message",
                 F.transform("files", lambda f: F.struct(
                     f["filename"].alias("filename"), F.when(f["status"] != "modified", f["status"]).alias("status"),
                     f["additions"].alias("additions"), f["deletions"].alias("deletions"), f["patch"].alias("patch"))).alias("files"),
                 total("additions").alias("a"), total("deletions").alias("d"))
    obj = F.struct(
        unpacked_sha("sha").alias("sha"),
        F.struct("message", F.struct(F.col("author").alias("name")).alias("author"),
                 F.struct(F.col("committer").alias("name")).alias("committer")).alias("commit"),
        F.struct((F.col("a") + F.col("d")).alias("total"), F.col("a").alias("additions"),
                 F.col("d").alias("deletions")).alias("stats"),
        "files")
    return g.select(F.to_json(obj).alias("value"))


def _doc_count(spark: SparkSession, sf_dir: str, batch_size: int = 500) -> DataFrame:
    """One row ``n``: of how many documents of about ``batch_size`` commits each sha gets one by hash (T6). No repository
    sort runs; which repository a document came from does not matter to the parsers."""
    shas = fx.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()  # a sha for each pair
    return shas.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(batch_size))).alias("n"))


def _batched(spark: SparkSession, sf_dir: str, n_docs: DataFrame) -> DataFrame:
    """The commits dealt to their documents (``by``) before any of their texts is made: the one shuffle that documents need."""
    return fx.commit_rows(fx.commit_pairs(spark, sf_dir, F.pmod(F.xxhash64("text"), n_docs.scalar()))).withColumn("sha", fx._sha_of("sha"))


def _doc(block: str) -> F.Column:
    return F.concat_ws("", F.collect_list(block))


def _doc_name(prefix: str) -> F.Column:
    return F.concat_ws("#", F.lit(f"{prefix}all"), F.col("by").cast("string"))


def _log_block(author: F.Column) -> F.Column:
    def line(f):
        binary = (f["additions"] == 0) & (f["deletions"] == 0)
        adds = F.when(binary, F.lit("-")).otherwise(f["additions"].cast("string"))
        dels = F.when(binary, F.lit("-")).otherwise(f["deletions"].cast("string"))
        return F.concat_ws("\t", adds, dels, f["filename"])

    return F.concat(F.lit(COMMIT_SEP), _nl(), F.col("sha"), _nl(), author, _nl(), F.col("committer"), _nl(), F.col("message"), _nl(),
                    F.lit(MSG_END), _nl(), _nl(), F.array_join(F.transform("files", line), "\n"), _nl())


def _status_block() -> F.Column:
    rev = F.create_map(*[F.lit(x) for k, v in STATUS_LETTERS.items() for x in (v, k)])
    lines = F.transform("files", lambda f: F.concat(rev[f["status"]], F.lit("\t"), f["filename"]))
    return F.concat(F.col("sha"), _nl(), F.array_join(lines, "\n"), _nl())


def _diff_docs(commits: DataFrame) -> DataFrame:
    """The diff of every commit that has files (``fx.packed_commit_files``): put together where the commit's row is made."""
    def text(older: str | None) -> F.Column:
        def block(f):
            head = F.concat(F.lit("diff --git a/"), f["filename"], F.lit(" b/"), f["filename"], _nl())
            return F.concat(*([] if older is None else [head, F.lit(older)]), head, f["patch"])
        return F.array_join(F.transform("files", block), "")

    docs = commits.where(F.col("n_files") > 0).select(unpacked_sha("sha").alias("sha"), text(None).alias("text"), text("@@ older @@\n").alias("twice"))
    return docs.select("sha", F.when(F.col("sha").startswith(TWICE), F.col("twice")).otherwise(F.col("text")).alias("text"))


def _git_log(spark: SparkSession, sf_dir: str, n_docs: DataFrame) -> DataFrame:
    """A document of each batch, and before it one of the older copies of its commits that were landed twice."""
    older = F.when(F.col("sha").startswith(TWICE), _log_block(F.lit("Older")))
    blocks = _batched(spark, sf_dir, n_docs).select("by", _log_block(F.col("author")).alias("block"), older.alias("older"))
    docs = blocks.groupBy("by").agg(_doc("block").alias("text"), _doc("older").alias("older"))
    both = F.array(F.struct(_doc_name("!").alias("doc_id"), F.col("older").alias("text")), F.struct(_doc_name("").alias("doc_id"), "text"))
    return docs.select(F.inline(both)).where("text <> ''")


def _git_status(spark: SparkSession, sf_dir: str, n_docs: DataFrame) -> DataFrame:
    listed = _batched(spark, sf_dir, n_docs).where(F.col("n_files") > 0).select("by", _status_block().alias("block"))
    return listed.groupBy("by").agg(_doc("block").alias("text")).select(_doc_name("").alias("doc_id"), "text")


# ---- landed inputs, stored once per input version (they are inputs of the parsers) ---------
def pr_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PR-list elements as JSON lines (``value``)."""
    return fx.stored(spark, sf_dir, "landed_pr_payloads", lambda: _pr_payloads(spark, sf_dir), LANDED_GROUP_BYTES)


def pr_payload_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored PR-list lines (for streams that read them as files land)."""
    return fx.stored_path(spark, sf_dir, "landed_pr_payloads", lambda: _pr_payloads(spark, sf_dir), LANDED_GROUP_BYTES)


def commit_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-list pages as JSON lines (``value``)."""
    return fx.stored(spark, sf_dir, "landed_commit_payloads", lambda: _commit_payloads(spark, sf_dir))


def detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit-detail objects as JSON lines (``value``)."""
    return fx.stored(spark, sf_dir, "landed_detail_payloads", lambda: _detail_payloads(spark, sf_dir), of_keys=True)


def _stored_doc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.stored(spark, sf_dir, "landed_doc_count", lambda: _doc_count(spark, sf_dir))


def git_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit logs with numstat as landed documents."""
    return fx.stored(spark, sf_dir, "landed_git_log", lambda: _git_log(spark, sf_dir, _stored_doc_count(spark, sf_dir)), of_keys=True)


def git_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name-status listings as landed documents."""
    return fx.stored(spark, sf_dir, "landed_git_status", lambda: _git_status(spark, sf_dir, _stored_doc_count(spark, sf_dir)), of_keys=True)


def git_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diffs as landed documents, one of each commit."""
    return fx.stored(spark, sf_dir, "landed_git_diff", lambda: _diff_docs(fx.packed_commit_files(spark, sf_dir)), of_keys=True)


def git_docs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(log docs, name-status docs, diff docs) as landed documents."""
    return git_log(spark, sf_dir), git_status(spark, sf_dir), git_diff(spark, sf_dir)


def build_all(spark: SparkSession, sf_dir: str) -> None:
    pr_payloads(spark, sf_dir)
    commit_payloads(spark, sf_dir)
    detail_payloads(spark, sf_dir)
    git_docs(spark, sf_dir)
