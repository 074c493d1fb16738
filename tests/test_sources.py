"""Payload and git-text sources: edge cases from FIXTURES.md."""

import json
import os
import tempfile

from pullscope.sources import gittext, payloads, sinks
from pullscope.sources.gittext import COMMIT_SEP, MSG_END


def _lines(spark, objs):
    return spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objs], "value string")


def test_pr_payload_edge_cases(spark):
    objs = [
        {"repo": "o/r", "id": 1, "number": 1, "title": "t", "user": None, "created_at": "2025-01-01T00:00:00Z",
         "merged_at": "top", "pull_request": None},
        {"repo": "o/r", "id": 2, "number": 2, "title": None, "user": {"login": "bob", "id": 5},
         "merged_at": "top", "pull_request": {}},
        {"repo": "o/r", "id": 3, "number": 3, "user": {"id": 6}, "merged_at": "top",
         "pull_request": {"merged_at": None, "url": "u"}},
        {"repo": "o/r", "id": 4, "number": 4, "user": {"login": "a"}, "merged_at": None,
         "pull_request": {"merged_at": "nested"}},
        {"repo": "x/y", "page": 2, "page_failed": True},
        "{not json",
    ]
    rows, errs = payloads.pull_requests_from_json(_lines(spark, objs))
    got = {r["id"]: (r["user"], r["title"], r["merged_at"]) for r in rows.collect()}
    assert got == {1: ("", "t", "top"), 2: ("bob", None, "top"), 3: ("", None, None), 4: ("a", None, "nested")}
    kinds = sorted((r["kind"], r["key"]) for r in errs.collect())
    assert kinds == [("malformed", "{not json"), ("page_failed", "x/y")]


def test_commit_pages_and_failed_pages(spark):
    def c(sha, login, name):
        return {"sha": sha, "author": None if login is None else {"login": login},
                "committer": {"login": "cm"}, "commit": {"message": "m", "author": {"name": name},
                                                         "committer": {"name": "N"}}}
    objs = [{"pr_id": 1, "page": 1, "commits": [c("a", "", "Git A"), c("b", None, "Git B")]},
            {"pr_id": 1, "page": 2, "commits": [c("z", "zz", "Z")]},
            {"pr_id": 2, "page": 1, "commits": [c("q", "q", "Q")]},
            {"pr_id": 2, "page": 2, "page_failed": True, "commits": []}]
    rows, bad = payloads.commits_from_json(_lines(spark, objs))
    got = sorted((r["sha"], r["pr_id"], r["author"], r["commit_seq"]) for r in rows.collect())
    assert got == [("a", 1, "Git A", 1), ("b", 1, "Git B", 2), ("z", 1, "zz", 101)]
    assert [(r["kind"], r["key"]) for r in bad.collect()] == [("page_failed", "2")]


def test_detail_payload_defaults(spark):
    objs = [{"sha": "s1", "commit": {"message": "m", "author": {"name": "A"}, "committer": {"name": "C"}},
             "stats": {"total": 7, "additions": 5, "deletions": 2},
             "files": [{"filename": "f", "additions": 5, "deletions": 2, "patch": "p"}]},
            {"sha": "s2", "commit": {"message": "m"}, "files": []}]
    out = {r["sha"]: r for r in payloads.details_from_json(_lines(spark, objs)).collect()}
    assert out["s1"]["status"] == "modified" and out["s1"]["commit_stats_total"] == 7
    assert out["s2"]["filename"] is None and out["s2"]["commit_stats_total"] == 0


def test_commit_log_parsing(spark):
    sha1, sha2 = "a" * 40, "b" * 40
    text = (f"{COMMIT_SEP}\n{sha1}\nAnn\nCid\nSubject line\n\nBody after blank\n{MSG_END}\n\n"
            f"3\t1\tsrc/a.py\n-\t-\tlogo.png\n\nbad line\n"
            f"{COMMIT_SEP}\n{sha2}\nBen\nCid\nEmpty commit\n{MSG_END}\n\n"
            f"{COMMIT_SEP}\nno end marker here\n")
    docs = spark.createDataFrame([("d1", text)], "doc_id string, text string")
    out = sorted(((r["sha"], r["message"], r["filename"], r["additions"], r["deletions"])
                  for r in gittext.details_from_log(docs).collect()), key=str)
    assert out == sorted([(sha1, "Subject line\n\nBody after blank", "src/a.py", 3, 1),
                          (sha1, "Subject line\n\nBody after blank", "logo.png", 0, 0),
                          (sha2, "Empty commit", None, None, None)], key=str)


def test_name_status_listing(spark):
    sha1, sha2 = "c" * 40, "d" * 40
    text = f"stray\tline\n{sha1}\nM\tsrc/a.py\nA\tnew.txt\nX\todd\n\n{sha2}\nR100\tmoved.py\nD\tgone\n"
    docs = spark.createDataFrame([("d", text)], "doc_id string, text string")
    got = sorted(tuple(r) for r in gittext.statuses_from_listing(docs).collect())
    assert got == sorted([(sha1, "src/a.py", "modified"), (sha1, "new.txt", "added"), (sha1, "odd", "X"),
                          (sha2, "moved.py", "renamed"), (sha2, "gone", "removed")])


def test_unified_diff_split(spark):
    big_ok = "é" * 5          # 10 bytes
    big_no = "é" * 5 + "x"    # 11 bytes
    text = ("diff --git a/x.py b/x.py\nindex 1..2\n@@ -1 +1 @@\n-a\rdiff --git inside\n+b\n"
            "diff --git a/dir b/f b/dir b/f\n" + big_ok + "\n"
            "diff --git a/big b/big\n" + big_no + "\n"
            "diff --git \"a/q\" \"b/q\"\nquoted\n")
    docs = spark.createDataFrame([("s", text)], "sha string, text string")
    full = {r["filename"]: r["patch"] for r in gittext.patches_from_diff(docs).collect()}
    assert full["x.py"] == "index 1..2\n@@ -1 +1 @@\n-a\rdiff --git inside\n+b\n"
    out = {r["filename"]: r["patch"] for r in gittext.patches_from_diff(docs, max_bytes=11).collect()}
    # a path holding ' b/' is cut at the first ' b/' (kept quirk): the name is wrong, the patch kept
    assert out["f b/dir b/f"] == big_ok + "\n"
    assert out["big"] is None          # 12 bytes with the newline > 11
    assert "q\"" not in out and len(out) == 3


def test_lossy_decode_of_landed_bytes(spark):
    d = tempfile.mkdtemp(prefix="ps-bin-")
    with open(os.path.join(d, "log.txt"), "wb") as fh:
        fh.write(b"ok \xff\xfe end")
    docs = gittext.read_text_docs(spark, d)
    assert docs.collect()[0]["text"] == "ok �� end"


def test_manifest_lists_rows_files_columns_and_bytes(spark):
    base = tempfile.mkdtemp(prefix="ps-sink-")
    spark.range(0, 100, 1, 4).write.parquet(f"{base}/a")
    spark.createDataFrame([], "x string, y long").write.parquet(f"{base}/empty")
    man = {r["table"]: (r["rows"], r["files"], r["columns"], r["bytes"] > 0) for r in
           sinks.manifest(spark, {"a": f"{base}/a", "empty": f"{base}/empty"}).collect()}
    assert man["a"] == (100, 4, "id", True) and man["empty"][0] == 0 and man["empty"][2] == "x,y"
    files = sinks.manifest_files(spark, {"a": f"{base}/a"}).collect()
    sizes = {n: os.path.getsize(f"{base}/a/{n}") for n in os.listdir(f"{base}/a") if n.endswith(".parquet")}
    assert {r["file"]: r["bytes"] for r in files} == sizes and [r["rows"] for r in files] == [25] * 4


def test_name_status_duplicates_and_headers_with_extra_text(spark):
    sha1 = "e" * 40
    text = f"{sha1}\nM\ta.py\n{sha1} trailing\nD\ta.py\nA\tb.py\n   {'f' * 40}\n\tM\tc.py\n"
    docs = spark.createDataFrame([("d", text)], "doc_id string, text string")
    got = sorted(tuple(r) for r in gittext.statuses_from_listing(docs).collect())
    assert got == sorted([(sha1, "a.py", "removed"), (sha1, "b.py", "added"), ("f" * 40, "c.py", "modified")])
