"""Streaming: resume, de-duplication, stream = batch."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from pullscope.streaming import ingest


def _write(d, name, objs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        for o in objs:
            fh.write(json.dumps(o) + "\n")


def _pr(i, login, title, ts):
    return {"repo": "o/r", "id": i, "number": i, "title": title, "user": {"login": login, "id": 1},
            "state": "closed", "created_at": ts, "merged_at": None, "html_url": "h"}


def test_resume_and_dedupe(spark):
    base = tempfile.mkdtemp(prefix="ps-stream-")
    land, out, ck = f"{base}/land", f"{base}/out", f"{base}/ckpt"
    dim = spark.createDataFrame([("bot", "Devin")], "user string, _label string")
    _write(land, "a.json", [_pr(1, "bot", "Fix crash", "2025-01-01T00:00:00Z"),
                            _pr(2, "human1", "Add x", "2025-01-02T00:00:00Z")])
    ingest.ingest_prs(spark, land, dim, out, ck, max_files=1).awaitTermination()
    first = {r["id"]: (r["agent"], r["type"]) for r in spark.read.parquet(out).collect()}
    assert first == {1: ("Devin", "fix"), 2: ("human", "other")}
    # re-delivery of id 1 plus a new PR: the resumed run reads only the new file, id 1 stays once
    _write(land, "b.json", [_pr(1, "bot", "Fix crash", "2025-01-01T00:00:00Z"),
                            _pr(3, "bot", "Docs", "2025-01-03T00:00:00Z")])
    ingest.ingest_prs(spark, land, dim, out, ck, max_files=1).awaitTermination()
    ids = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 3]


def test_volume_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="ps-vol-")
    land = f"{base}/land"
    objs = [_pr(i, "bot" if i % 3 == 0 else f"h{i}", "t", f"2025-0{1 + i % 3}-1{i % 9}T0{i % 10}:00:00Z")
            for i in range(60)]
    for k in range(3):
        _write(land, f"p{k}.json", objs[k::3])
    dim = spark.createDataFrame([("bot", "Devin")], "user string, _label string")
    ingest.volume_stream(spark, land, dim, f"{base}/out", f"{base}/ckpt", max_files=1).awaitTermination()
    daily = ingest.volume_table(spark, f"{base}/out")
    got = sorted(tuple(r) for r in daily.collect())
    exp = {}
    for o in objs:
        key = (o["created_at"][:10], "agent" if o["user"]["login"] == "bot" else "human")
        exp[key] = exp.get(key, 0) + 1
    assert got == sorted((k[0], k[1], v) for k, v in exp.items())
    monthly = {r["month"]: r["total"] for r in ingest.monthly_from_daily(daily).collect()}
    assert sum(monthly.values()) == 60


def test_progress_table(spark):
    base = tempfile.mkdtemp(prefix="ps-prog-")
    land = f"{base}/land"
    _write(land, "a.json", [_pr(1, "x", "t", "2025-01-01T00:00:00Z")])
    _write(land, "b.json", [_pr(2, "x", "t", "2025-01-02T00:00:00Z")])
    dim = spark.createDataFrame([("bot", "Devin")], "user string, _label string")
    q = ingest.ingest_prs(spark, land, dim, f"{base}/out", f"{base}/ckpt", max_files=1)
    q.awaitTermination()
    prog = ingest.progress_table(spark, f"{base}/out")
    assert prog.agg(F.sum("written_rows")).first()[0] == 2
    assert prog.agg(F.sum("input_rows")).first()[0] == 2


def _run(spark, base, dim=None, **options):
    dim = dim or spark.createDataFrame([("bot", "Devin")], "user string, _label string")
    ingest.ingest_prs(spark, f"{base}/land", dim, f"{base}/out", f"{base}/ckpt", **options).awaitTermination()


def test_dead_letters_are_written_with_the_rows_and_retried_once(spark):
    base = tempfile.mkdtemp(prefix="ps-dead-")
    good = _pr(1, "x", "t", "2025-01-01T00:00:00Z")
    _write(f"{base}/land", "a.json", [good, {"repo": "o/r", "page": 3, "page_failed": True}, {"repo": "o/s", "message": "Not Found"}])
    with open(f"{base}/land/b.json", "w") as fh:
        fh.write("{not json\n" + json.dumps({"repo": "o/r", "page": 3, "page_failed": True}) + "\n\n" + '{"id": "text", "repo": 4}\n')
    _run(spark, base)
    _write(f"{base}/land", "c.json", [{"repo": "o/r", "page": 3, "page_failed": True}, good])  # nothing new
    _run(spark, base)
    got = sorted((r["kind"], r["repo"] or "") for r in ingest.dead_letters(spark, f"{base}/out").collect())
    assert [k for k, _ in got] == ["malformed"] * 3 + ["no_id", "page_failed"]
    assert {("no_id", "o/s"), ("page_failed", "o/r")} <= set(got)
    assert [r["id"] for r in spark.read.parquet(f"{base}/out").collect()] == [1]
    second = [_pr(7, "x", "t", "2025-01-01T00:00:00Z"), {**_pr(8, "x", "t", None), "repo": "o/other"}, {"repo": "o/s", "page_failed": True}]
    rows, still = ingest.retry_dead_letters(spark, f"{base}/out", spark.createDataFrame([(json.dumps(o),) for o in second], "value string"))
    assert [r["id"] for r in rows.collect()] == [7] and [(r["kind"], r["key"]) for r in still.collect()] == [("page_failed", "o/s")]


def test_unequal_copies_of_an_id_keep_the_one_landed_first(spark):
    import time
    for files, at_once in ((1, False), (100, True)):  # one file per batch, all files in one batch
        base = tempfile.mkdtemp(prefix="ps-copies-")
        for k, title in enumerate(["first", "second", "third"]):
            _write(f"{base}/land", f"{9 - k}.json", [_pr(1, "x", title, f"2025-0{k + 1}-01T00:00:00Z"), _pr(10 + k, "x", title, None)])
            os.utime(f"{base}/land/{9 - k}.json", (time.time() - 100 + k, time.time() - 100 + k))
        _write(f"{base}/land", "same.json", [_pr(5, "x", t, None) for t in "abc"])  # in one file: the least hash of the line
        os.utime(f"{base}/land/same.json", (time.time() - 50, time.time() - 50))
        _run(spark, base, max_files=files)
        rows = {r["id"]: r["title"] for r in spark.read.parquet(f"{base}/out").collect()}
        assert sorted(rows) == [1, 5, 10, 11, 12] and rows[1] == "first"
        lines = spark.createDataFrame([(json.dumps(_pr(5, "x", t, None)), t) for t in "abc"], "v string, t string")
        assert rows[5] == lines.select(F.min(F.struct(F.xxhash64("v"), "t"))["t"]).first()[0]


def test_a_batch_that_died_before_its_commit_is_replayed_and_replaced(spark, small_dir):
    from pullscope.plans.registry_flow import interrupted_ingest
    from pullscope.sources import fixtures as fx, landed
    base = tempfile.mkdtemp(prefix="ps-resume-")
    interrupted_ingest(spark, small_dir, base)
    ids = [r["id"] for r in spark.read.parquet(f"{base}/out").select("id").collect()]
    assert len(ids) == len(set(ids)) == fx.raw_prs(spark, small_dir).count()
    progress = ingest.progress_table(spark, f"{base}/out", 10).orderBy("batch_id").collect()
    assert [r["batch_id"] for r in progress] == list(range(len(progress))) and len(progress) > 2
    lines = landed.pr_payloads(spark, small_dir).count()
    assert sum(r["input_rows"] for r in progress) == lines == progress[-1]["done"]  # no file was read twice
    files = sum(n.endswith(".parquet") for n in os.listdir(f"{base}/land"))
    assert sum(r["files"] for r in progress) == files


def test_state_is_kept_in_rocksdb(spark):
    base = tempfile.mkdtemp(prefix="ps-rocks-")
    _write(f"{base}/land", "a.json", [_pr(1, "x", "t", None)])
    _run(spark, base)
    names = [n for _d, _s, names in os.walk(f"{base}/ckpt/state") for n in names]
    assert any(n.endswith((".changelog", ".zip")) for n in names) and not any(n.endswith(".delta") for n in names)


def test_file_names_with_blanks_and_signs(spark):
    base = tempfile.mkdtemp(prefix="ps-names-")
    for k, name in enumerate(["a b.json", "c+d.json", "e%20f.json", "gé.json"]):
        _write(f"{base}/land", name, [_pr(k, "x", "t", None)])
    _run(spark, base)
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect()) == [0, 1, 2, 3]


def test_late_rows_are_kept_and_malformed_times_do_not_stop_the_stream(spark):
    base = tempfile.mkdtemp(prefix="ps-late-")
    land = f"{base}/land"
    times = ["2025-01-20T00:00:00Z", "2025-01-21T00:00:00Z", "2012-01-01T00:00:00Z", "not a time", "2025-01-22T00:00:00Z"]
    for k, ts in enumerate(times):
        _write(land, f"f{k}.json", [_pr(k, "x", "t", ts), _pr(0, "x", "t", times[0])])
    dim = spark.createDataFrame([("bot", "Devin")], "user string, _label string")
    ingest.ingest_prs(spark, land, dim, f"{base}/out", f"{base}/ck1", max_files=1).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect()) == [0, 1, 2, 3, 4]
    ingest.volume_stream(spark, land, dim, f"{base}/vol", f"{base}/ck2", max_files=1).awaitTermination()
    got = {r["day"]: r["count"] for r in ingest.volume_table(spark, f"{base}/vol").collect()}
    assert got == {"2025-01-20": 6, "2025-01-21": 1, "2012-01-01": 1, None: 1, "2025-01-22": 1}
