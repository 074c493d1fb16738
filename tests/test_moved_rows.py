"""What is moved and built: lines of git output stay where they are read, look-ups join few columns, rows that lie by
sha are not dealt again, and no query builds a table that it does not read."""

import os
import re
import tempfile

import pytest

from pyspark.sql import functions as F

from pullscope.functions.scalars import packed_sha, unpacked_sha
from pullscope.operators import revisions
from pullscope.operators.labels import filter_to_prs
from pullscope.plans.collect import details_from_git
from pullscope.plans.registry import queries
from pullscope.session import apply_conf
from pullscope.sources import fixtures as fx
from pullscope.sources import gitbytes, landed
from pullscope.sources.gittext import COMMIT_SEP, MSG_END


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _moved(plan: str) -> list[str]:
    """The columns that every exchange, sort and window of a plan takes in."""
    return re.findall(r"\(\d+\) (?:Exchange|Sort|Window)\nInput \[\d+\]: \[(.*)\]", plan)


@pytest.fixture
def log_dir():
    base = tempfile.mkdtemp(prefix="ps-moved-")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/log", "w") as fh:
        for i in range(50):
            fh.write("\n".join([COMMIT_SEP, f"{i:040x}", "a", "c", "m", MSG_END, "", "1\t2\tf", ""]))
    return f"{base}/in"


def test_lines_are_put_together_where_they_are_read(spark, log_dir):
    lines = gitbytes.read_landed_lines(spark, log_dir)
    for docs in (gitbytes.log_records(lines), gitbytes.listing_records(lines), gitbytes.diff_records(lines)):
        moved = _moved(_plan(docs))
        assert moved and not any("line#" in m for m in moved)


def test_lines_out_of_order_give_the_same_records(spark, log_dir):
    lines = gitbytes.read_landed_lines(spark, log_dir)
    want = sorted(gitbytes.log_records(lines).collect())
    assert len(want) == 50
    assert sorted(gitbytes.log_records(lines.repartition(7, "pos")).collect()) == want


def test_status_and_totals_take_rows_that_lie_by_sha(spark):
    apply_conf(spark)
    docs = spark.createDataFrame([], "doc_id string, text string")
    plan = _plan(details_from_git(docs, docs, None, spark.createDataFrame([], "sha string, pr_id long")))
    assert not re.search(r"hashpartitioning\(sha#\d+, filename#\d+", plan)


def test_details_are_dealt_by_sha_once(spark, small_dir, monkeypatch):
    """The file rows and the bridge, each at most once; the file rows are not read back from a table for it."""
    apply_conf(spark)
    monkeypatch.setattr(fx, "commit_files", None)
    keys = re.findall(r"hashpartitioning\(([^,]*)", _plan(fx._build_commit_details(spark, small_dir, True)))
    assert 1 <= len(keys) <= 2 and all(k.startswith("sha#") for k in keys)


def test_shas_are_packed_and_unpacked(spark):
    shas = ["00ff" * 10, "01", "", "0", "A1", "0g", "é", "\x01\x02", None, "a" * 40]
    rows = spark.createDataFrame([(s,) for s in shas], "sha string").select("sha", packed_sha("sha").alias("p"))
    got = rows.select("sha", "p", unpacked_sha("p").alias("back")).collect()
    assert all(r["sha"] == r["back"] for r in got) and len({bytes(r["p"]) for r in got if r["p"] is not None}) == len(shas) - 1
    assert max(len(r["p"]) for r in got if r["sha"] in (shas[0], shas[-1])) == 21


def _dealt_types(df) -> list:
    """The shas that exchanges deal rows by: packed ones come from an alias made before, as text they are hex digits."""
    plan = _plan(df)
    return [m for m in re.findall(r"Arguments: hashpartitioning\(([^,]*),", plan) if m.startswith("sha#")]


@pytest.mark.parametrize("build", [landed._detail_payloads, lambda s, d: landed._diff_docs(fx.packed_commit_files(s, d))])
def test_landed_commits_are_put_together_where_their_rows_are_made(spark, small_dir, monkeypatch, build):
    apply_conf(spark)
    monkeypatch.setattr(fx, "commit_files", None)
    assert len(_dealt_types(build(spark, small_dir))) == 1


def test_details_move_packed_shas(spark, small_dir):
    """Totals and fan-out take binary shas: half the bytes of the text in both exchanges; the result has the text."""
    files = fx.packed_commit_files(spark, small_dir)
    assert dict(files.dtypes)["sha"] == "binary"
    out = fx._build_commit_details(spark, small_dir, True)
    assert dict(out.dtypes)["sha"] == "string" and out.where("length(sha) <> 40").count() == 0
    assert len(_dealt_types(out)) <= 2


def test_look_ups_join_few_columns(spark, small_dir):
    moved = _moved(_plan(fx._build_pull_requests(spark, small_dir)))
    assert not any("html_url" in m and "title" in m for m in moved)
    assert not any("repo_url" in m for m in moved if "o_orderstatus" in m)


@pytest.mark.parametrize("query,unread", [
    ("state_breakdown", [(fx, "commits")]), ("classified_prs", [(fx, "commits")]), ("description_length", [(fx, "commits")]),
    ("missing_shas", [(landed, "git_status"), (landed, "git_diff")]), ("capped_patches", [(landed, "git_log"), (landed, "git_status")]),
    ("patches_from_bytes", [(landed, "git_log"), (landed, "git_status")]), ("details_from_bytes", [(landed, "git_diff")])])
def test_no_table_is_built_that_is_not_read(spark, small_dir, monkeypatch, query, unread):
    def built(*_args, **_options):
        raise AssertionError("built, but not read")
    for module, name in unread:
        monkeypatch.setattr(module, name, built)
    assert queries()[query](spark, small_dir).columns


def test_a_build_moves_no_column_that_commits_are_not_made_of(spark, small_dir):
    moved = _moved(_plan(fx._build_commits(spark, small_dir)))
    assert moved and not any("l_shipdate" in m or "l_extendedprice" in m for m in moved)


def test_equal_commits_of_a_pr_are_numbered_whatever_else_differs(spark, tmp_path):
    """Rows with the same number, part and supplier give the same commit: their other columns need not order them."""
    spark.sql("""select 1L l_orderkey, 7L l_partkey, 3L l_suppkey, 1 l_linenumber, cast(id as double) l_quantity from range(3)
                 union all select 1L, 6L, 3L, 1, 9D union all select 1L, 5L, 3L, null, 9D""").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = fx._build_commits(spark, str(tmp_path)).orderBy("commit_seq").collect()
    assert [(r["commit_seq"], r["message"]) for r in got] == [(i + 1, f"Update part {p}") for i, p in enumerate([5, 6, 7, 7, 7])]


def test_fix_rows_move_packed_shas(spark, small_dir):
    """The semi-join with the fix PRs takes shas as bytes; rows and text are those of a plain semi-join."""
    apply_conf(spark)
    cm, ids = fx.commits(spark, small_dir), fx.pull_requests(spark, small_dir).where("id % 3 = 0")
    kept = filter_to_prs(cm, ids)
    assert kept.columns == cm.columns and dict(kept.dtypes)["sha"] == "string"
    plain = cm.join(ids.select(F.col("id").alias("pr_id")), "pr_id", "left_semi").select(*cm.columns)
    assert sorted(kept.collect()) == sorted(plain.collect())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = _plan(filter_to_prs(cm, ids))
        scan = int(re.search(r"\((\d+)\) Scan parquet \nOutput \[\d+\]: \[sha#", steps).group(1))
        dealt = re.search(r"Exchange\nInput \[\d+\]: \[([^\]]*author[^\]]*)\]", steps).group(1)
        read = re.search(rf"\({scan}\) Scan parquet \nOutput \[\d+\]: \[(sha#\d+)", steps).group(1)
        assert "sha#" in dealt and read not in dealt.split(", ")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _naive_revision_shas(rows, revised):
    by_pr = {}
    for sha, pr, seq in rows:
        by_pr.setdefault(pr, []).append((seq, sha))
    out = {}
    for pr, source in revised:
        known = [(q, s) for q, s in by_pr.get(pr, []) if q is not None]
        shas, firsts = out.setdefault(source, (set(), set()))
        shas.update(s for _q, s in by_pr.get(pr, []))
        if known:
            firsts.add(min(known)[1])
    return {g: {s for s in shas - firsts if s is not None} for g, (shas, firsts) in out.items()}


def test_commits_of_revised_prs_are_moved_once(spark):
    """First commits and revision commits come from one shuffle; shas equal a plain computation, odd rows included."""
    rows = [("a", 1, 1), ("b", 1, 2), ("b", 2, 1), ("c", 2, 2), ("a", 2, 3), (None, 3, 1), ("d", 3, 2), ("e", 4, None),
            ("f", 4, None), ("g", 5, 1), ("g", 5, 2), ("h", 5, 3), ("0a", 6, 2), ("0A", 6, 1), ("h", 6, 3), ("x", 9, 1)]
    prs = [(1, "agent"), (2, "agent"), (3, "human"), (4, "human"), (5, "human"), (6, "agent")]
    cm = spark.createDataFrame(rows, "sha string, pr_id long, commit_seq int")
    rev = spark.createDataFrame(prs, "pr_id long, source string")
    dt = spark.createDataFrame([(s, p, f"{s}{p}", 1, 1) for s, p, _q in rows], "sha string, pr_id long, filename string, additions long, deletions long")
    want = _naive_revision_shas(rows, prs)
    got = revisions.revision_size_by(rev, cm, dt, "source").collect()
    files = {(g, p): {f"{s}{p}" for s, q, _n in rows if q == p and s in shas} for g, shas in want.items() for p in range(10)}
    assert {(r["source"], r["pr_id"]): r["rev_files_changed"] for r in got} == {k: len(v) for k, v in files.items() if v}
    everywhere = _naive_revision_shas(rows, [(p, "all") for p, _g in prs])["all"]
    kept = revisions.revision_details(rev, cm, dt).select("sha").distinct().collect()
    assert {r["sha"] for r in kept} == everywhere


def test_revision_commits_are_read_from_one_exchange(spark, small_dir):
    apply_conf(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries()["revision_size_rows_by_source"](spark, small_dir)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"FileScan parquet \[sha#\d+,pr_id#\d+L,commit_seq", final)) == 1


def test_details_are_built_of_one_exchange(spark, small_dir):
    apply_conf(spark)
    df = fx._build_commit_details(spark, small_dir, False)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ReusedExchange" in final and len(re.findall("FileScan", final)) == 1


def test_landed_lines_lie_in_one_set_of_files(spark, small_dir):
    """What a listing also holds lies with the lines of its PRs, and pages are put together from packed commits."""
    assert _plan(landed._pr_payloads(spark, small_dir)).count("Scan parquet") <= 2  # named in the tree and below it
    moved = [m for m in _moved(_plan(landed._commit_payloads(spark, small_dir))) if "commit_seq" in m]
    assert moved and all("author" in m for m in moved)


def test_streams_have_no_more_state_stores_than_the_cluster_works_on(spark, small_dir, tmp_path):
    from pullscope.streaming.ingest import ingest_prs, state_stores
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        os.makedirs(f"{tmp_path}/in")
        with open(f"{tmp_path}/in/a.json", "w") as fh:
            fh.write('{"id": 1, "repo": "o/r", "title": "Fix", "created_at": "2020-01-01T00:00:00Z"}\n')
        dim = spark.createDataFrame([], "user string, _label string")
        ingest_prs(spark, f"{tmp_path}/in", dim, f"{tmp_path}/out", f"{tmp_path}/ckpt").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        stores = [p for p in os.listdir(f"{tmp_path}/ckpt/state/0") if p.isdigit()]
        assert 1 <= len(stores) <= state_stores(spark) < 40
        assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_cuts_to_fix_prs_read_no_bodies(spark, small_dir):
    from pullscope.plans.registry import _fix
    r = _fix(spark, small_dir, with_body=True)
    assert "doc_id" in _plan(r.fix_prs) and "doc_id" not in _plan(r.fix_commits) + _plan(r.fix_details)


def test_shas_of_revised_prs_are_moved_packed(spark):
    cm = spark.createDataFrame([("0a", 1, 1), ("0b", 1, 2)], "sha string, pr_id long, commit_seq int")
    dt = spark.createDataFrame([("0b", 1, "f", 1, 1)], "sha string, pr_id long, filename string, additions long, deletions long")
    rev = spark.createDataFrame([(1, "agent")], "pr_id long, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [_plan(revisions.revision_size_by(rev, cm, dt)), _plan(revisions.revision_details(rev, cm, dt.select("sha", "pr_id")))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for plan in plans:
        moved = [x for x in _moved(plan) if "commit_seq" in x]
        assert moved and not any(re.search(r"\bsha#", x) for x in moved)


def test_report_sizes_revisions_before_the_cut(spark, small_dir):
    """The revision sizes of the report equal those of the cut tables, shared shas and PRs that are no fix included."""
    from pullscope.plans.registry import _fix
    from pullscope.plans.report import build_report
    r = _fix(spark, small_dir, with_body=True)
    cm, dt = fx.commits(spark, small_dir), fx.commit_details(spark, small_dir)
    sets = [(r.fix_commits, r.fix_details, cm, dt)]
    # forty shas for two thirds of the PRs, so that details of other PRs (also of PRs that are no fix) are chosen
    share = lambda df: df.withColumn("sha", F.when(F.col("pr_id") % 3 > 0, F.concat(F.lit("s"), F.pmod(F.xxhash64("sha"), F.lit(40)))).otherwise(F.col("sha")))
    cut = lambda df: filter_to_prs(df, r.fix_prs)
    sets.append((cut(share(cm)), cut(share(dt)), share(cm), share(dt)))
    for fc, fd, commits, details in sets:
        want, got = build_report(r.fix_prs, fc, fd), build_report(r.fix_prs, fc, fd, commits=commits, details=details)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
