"""What is read, moved and written again: lines of git output are read once, landed text is made where its commits were dealt."""

import re

import pytest
from pyspark.sql import functions as F

from pullscope.session import apply_conf
from pullscope.sources import fixtures as fx
from pullscope.sources import gitbytes, gittext, landed
from pullscope.sources.gittext import COMMIT_SEP, MSG_END


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _moved(df) -> list[str]:
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", _plan(df))


@pytest.fixture
def lines(spark, tmp_path):
    with open(f"{tmp_path}/log", "w") as fh:
        for i in range(20):
            fh.write("\n".join([COMMIT_SEP, f"{i:040x}", "a", "c", "m", MSG_END, "", "1\t2\tf", ""]))
    return gitbytes.read_landed_lines(spark, str(tmp_path))


def test_lines_are_read_once(lines):
    """Whole records, borders and last headers are all made of the pieces that were written."""
    for docs in (gitbytes.log_records(lines), gitbytes.listing_records(lines), gitbytes.diff_records(lines)):
        assert not re.search("Scan text|MapInArrow", _plan(docs))
    assert gitbytes.log_records(lines).count() == 20


def test_whole_records_that_are_not_wanted_are_not_written(spark, tmp_path):
    with open(f"{tmp_path}/diff", "w") as fh:
        for i in range(9):
            fh.write(f"{i:040x}\nnoise\ndiff --git a/f b/f\n@@ {i} @@\n")
    docs = gitbytes.diff_records(gitbytes.read_landed_lines(spark, str(tmp_path)))
    assert sorted((r["sha"], r["text"]) for r in docs.collect()) == [(f"{i:040x}", f"diff --git a/f b/f\n@@ {i} @@\n") for i in range(9)]
    written = spark.read.schema(gitbytes._PIECE).parquet(*docs.inputFiles())
    assert written.where("owner is not null and not edge and text not like 'diff%'").count() == 0


@pytest.mark.parametrize("read", [gittext.details_from_log, gittext.statuses_from_listing])
def test_shas_of_git_text_are_dealt_packed(spark, read):
    docs = spark.createDataFrame([("d", "")], "doc_id string, text string")
    out = read(docs, packed=True)
    assert dict(out.dtypes)["sha"] == "binary" and dict(read(docs).dtypes)["sha"] == "string"


def test_blocks_with_odd_heads_and_markers(spark):
    sep, end = COMMIT_SEP, MSG_END
    text = "\n".join(["before", sep, "s1", "a", "c", "m", end + "1\t2\tx" + end, sep, "s2", "a", end, sep, "s3", "a", "c", "no end",
                      sep, " s4 ", " a ", "", " two", "lines ", end, "", "-\t-\tf", "", sep, end, sep, "s1", "b", "c", "", end])
    got = sorted(map(tuple, gittext.details_from_log(spark.createDataFrame([("d", text)], "doc_id string, text string")).collect()), key=repr)
    assert got == [("s1", "b", "c", "", None, None, None), ("s4", "a", "", "two\nlines", "f", 0, 0)]


@pytest.mark.parametrize("build", [landed._git_log, landed._git_status])
def test_documents_are_dealt_before_their_texts_are_made(spark, small_dir, monkeypatch, build):
    """No table of file rows is built for them, and no text is moved."""
    apply_conf(spark)
    n_docs = landed._doc_count(spark, small_dir)
    monkeypatch.setattr(fx, "commit_files", None)
    moved = _moved(build(spark, small_dir, n_docs.localCheckpoint()))
    assert moved and not any(re.search("author|filename|message|status|block", m) for m in moved)


def test_builds_move_part_and_supplier_in_place_of_shas(spark, small_dir):
    apply_conf(spark)
    assert dict(fx.commit_pairs(spark, small_dir).dtypes)["sha"].startswith("struct<p:bigint")
    for df in (fx._build_commit_files(spark, small_dir), fx._build_commit_details(spark, small_dir), landed._detail_payloads(spark, small_dir)):
        moved = _moved(df)
        assert moved and all(re.fullmatch(r"sha#\d+(, _keys#\d+)?", m) for m in moved)


def test_commits_without_part_have_no_sha(spark, tmp_path):
    spark.sql("""select 1L l_orderkey, 7L l_partkey, 3L l_suppkey union all select 2L, 7L, 3L union all select 3L, null, 3L
                 union all select 4L, 7L, null""").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = fx._build_commit_files(spark, str(tmp_path)).groupBy("sha").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sorted((r["sha"] is None, r["n"]) for r in got) == [(False, 2), (True, 1)]
    details = fx._build_commit_details(spark, str(tmp_path)).collect()
    assert sorted(r["pr_id"] for r in details) == [1, 1, 2, 2] and len({r["filename"] for r in details}) == 2
