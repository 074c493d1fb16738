"""Sinks, state and quality helpers: round trips."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from pullscope.functions import scalars as S
from pullscope.operators import quality, sampling
from pullscope.plans.report import with_text
from pullscope.schemas import COMMITS, PULL_REQUESTS
from pullscope.sources import sinks, state, tables


def test_state_versions_and_remaining(spark):
    base = tempfile.mkdtemp(prefix="ps-state-")
    assert state.read_state(spark, base + "/absent").count() == 0
    s1 = spark.createDataFrame([("prs", "o/a", "done", None, None), ("prs", "o/b", "error", "timeout", None)],
                               "phase string, key string, kind string, detail string, run_id string")
    state.write_state(s1, base + "/st", "r1")
    s2 = s1.union(spark.createDataFrame([("prs", "o/b", "done", None, None)], s1.schema))
    state.write_state(s2, base + "/st", "r2")
    cur = state.read_state(spark, base + "/st")
    assert cur.select("run_id").distinct().collect()[0][0] == "r2"
    keys = spark.createDataFrame([("o/a",), ("o/b",), ("o/c",)], "key string")
    assert sorted(r[0] for r in state.remaining(keys, cur).collect()) == ["o/c"]
    assert sorted(r[0] for r in state.retry_set(keys, cur).collect()) == ["o/b"]


def test_state_versions_follow_their_order_not_their_names(spark):
    base = tempfile.mkdtemp(prefix="ps-state-")
    row = lambda k: spark.createDataFrame([("prs", k, "done", None, None)], "phase string, key string, kind string, detail string, run_id string")
    for run in ("8", "9", "10"):
        state.write_state(row(f"o/{run}"), base, run)
    assert [r["key"] for r in state.read_state(spark, base).collect()] == ["o/10"]
    state.write_state(row("o/a").limit(0), base, "11")
    assert state.read_state(spark, base).count() == 0


def test_a_version_with_a_damaged_file_does_not_count_at_all(spark):
    base = tempfile.mkdtemp(prefix="ps-state-")
    rows = [("prs", f"o/{i}", "done", None, None) for i in range(50)]
    df = spark.createDataFrame(rows, "phase string, key string, kind string, detail string, run_id string").repartition(5)
    state.write_state(df.limit(7), base, "a")
    state.write_state(df, base, "b")
    assert state.read_state(spark, base).count() == 50

    def damage(run):
        part = next(n for n in sorted(os.listdir(f"{base}/run={run}")) if n.endswith(".parquet"))
        with open(f"{base}/run={run}/{part}", "r+b") as fh:
            fh.seek(-8, 2)
            fh.write(b"damaged!")
        crc = f"{base}/run={run}/.{part}.crc"
        if os.path.exists(crc):
            os.rename(crc, f"{base}/{run}.crc")

    damage("b")
    assert state.read_state(spark, base).count() == 7  # none of the 50, not 40 of them
    damage("a")
    assert state.read_state(spark, base).count() == 0


def test_path_errors_other_than_absence_are_raised(spark):
    import pytest
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        tables.path_exists(spark, "nosuchscheme://host/x")


def test_imported_state_and_corrupt_file(spark):
    d = tempfile.mkdtemp(prefix="ps-imp-")
    with open(os.path.join(d, "checkpoint_prs.json"), "w") as fh:
        json.dump({"done_repos": ["o/a", "o/b"], "all_prs": [], "errors": ["o/b"], "skipped": []}, fh)
    with open(os.path.join(d, "checkpoint_bad.json"), "w") as fh:
        fh.write("{broken")
    st = state.read_imported_state(spark, d, "prs")
    got = sorted((r["key"], r["kind"]) for r in st.collect())
    assert got == [("o/a", "done"), ("o/b", "done"), ("o/b", "error")]


def test_csv_samples_report_text(spark):
    base = tempfile.mkdtemp(prefix="ps-out-")
    df = spark.range(0, 100).withColumn("v", F.col("id") * 2)
    sinks.write_csv(df, base + "/csv", single_file=True)
    back = spark.read.option("header", True).csv(base + "/csv")
    assert back.count() == 100 and back.columns == ["id", "v"]
    sinks.write_samples({"t": df}, base + "/samples", n=20, keys={"t": ["id"]})
    assert spark.read.option("header", True).csv(base + "/samples/t_sample").count() == 20
    rep = spark.createDataFrame([("merge_rate", "agent", "merge_rate", 12.345), ("overview", None, "prs", 1234567.0),
                                 ("merge_rate_test", None, "p_value", None)],
                                "section string, grp string, metric string, value double")
    lines = {r["metric"]: r["text"] for r in with_text(rep).collect()}
    assert lines["merge_rate"].endswith("12.3") and lines["prs"].endswith("1,234,567")
    assert lines["p_value"].endswith("n/a")
    sinks.write_report(with_text(rep), base + "/report")
    assert spark.read.text(base + "/report/text").count() == 3


def test_optional_inputs(spark):
    base = tempfile.mkdtemp(prefix="ps-opt-")
    assert tables.read_optional(spark, base + "/nope", COMMITS) is None
    try:
        tables.read_optional(spark, base + "/nope", COMMITS, required=True)
        raise AssertionError("expected an error")
    except FileNotFoundError:
        pass
    spark.createDataFrame([], COMMITS).write.parquet(base + "/c")
    assert tables.read_optional(spark, base + "/c", COMMITS).count() == 0


def test_stored_order_and_head(spark):
    base = tempfile.mkdtemp(prefix="ps-ord-")
    spark.range(0, 50).coalesce(1).write.parquet(base + "/t")
    df = tables.with_stored_order(spark.read.parquet(base + "/t"))
    assert [r["id"] for r in sampling.head_in_order(df, 5).collect()] == [0, 1, 2, 3, 4]
    for name, first in (("part-99999-x", 0), ("part-100000-x", 10), ("other", 20)):
        spark.range(first, first + 2).coalesce(1).write.parquet(f"{base}/{name}")
        part = next(n for n in os.listdir(f"{base}/{name}") if n.startswith("part-"))
        os.makedirs(f"{base}/u", exist_ok=True)
        os.link(f"{base}/{name}/{part}", f"{base}/u/{name}.parquet")
    df = tables.with_stored_order(spark.read.parquet(base + "/u"))
    assert [r["id"] for r in sampling.head_in_order(df, 6).collect()] == [20, 21, 0, 1, 10, 11]


def test_conformance(spark):
    prs = spark.createDataFrame([], PULL_REQUESTS).drop("body")
    rows = quality.conformance(spark, {"pull_requests": prs}, {"pull_requests": PULL_REQUESTS}).collect()
    missing = [r["column"] for r in rows if not r["present"]]
    assert missing == ["body"] and all(r["matches"] for r in rows if r["present"])
    other = spark.createDataFrame([(1, None, "x"), (2, "t", "x"), (None, None, "x")], "id long, title string, more string")
    held = {r["column"]: (r["actual"], r["matches"], r["values"], r["nulls"]) for r in
            quality.conformance(spark, {"pull_requests": other}, {"pull_requests": PULL_REQUESTS}, counts=True).collect()}
    assert held["id"] == ("bigint", True, 2, 1) and held["title"][2:] == (1, 2)
    assert held["more"] == ("string", False, 3, 0) and held["body"] == (None, False, None, None)


def test_slug_and_rate(spark):
    df = spark.createDataFrame([("o/r", 100, 0), ("a/b/c", 50, 1800)], "r string, n long, s long")
    got = df.select(S.repo_slug("r").alias("s"), S.rate_per_hour("n", "s").alias("h")).collect()
    assert [g["s"] for g in got] == ["o__r", "a__b__c"] and [g["h"] for g in got] == [360000.0, 100.0]


def test_report_with_written_fact_table_equals_lazy(spark, small_dir):
    from pullscope.plans.registry import _fix
    from pullscope.plans.report import build_report
    r = _fix(spark, small_dir, with_body=True)
    a = build_report(r.fix_prs, r.fix_commits, r.fix_details, checkpoint=False)
    b = build_report(r.fix_prs, r.fix_commits, r.fix_details, checkpoint=True)
    key = lambda row: (row["section"], row["grp"] or "", row["metric"])
    ra = sorted(a.collect(), key=key)
    rb = sorted(b.collect(), key=key)
    assert [key(x) for x in ra] == [key(x) for x in rb]
    for x, y in zip(ra, rb):
        assert (x["value"] is None and y["value"] is None) or abs(x["value"] - y["value"]) < 1e-9


def test_stored_tables_concurrent_builders(spark):
    import threading
    from pullscope.sources import fixtures as fx
    d = "/root/testdata/sf0.001"
    calls = []

    def build():
        calls.append(1)
        return spark.range(0, 100)

    out = []
    ths = [threading.Thread(target=lambda: out.append(fx.stored(spark, d, "concurrency_probe", build).count()))
           for _ in range(3)]
    for t in ths:
        t.start()
    for t in ths:
        t.join()
    assert out == [100, 100, 100]
    assert fx.stored(spark, d, "concurrency_probe", build).count() == 100


def test_tables_in_stored_order_are_written_by_many_tasks(spark, monkeypatch, small_dir):
    from pullscope.plans import registry_more
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    for query, down in ((registry_more.q_first, False), (registry_more.q_labels_stored, True)):
        base = tempfile.mkdtemp(prefix="ps-ord-") + "/t"

        def landing(spark, name):  # called inside the query: its small table is to stay in all its partitions
            spark.conf.set(key, "false")
            return base

        monkeypatch.setattr(registry_more, "_landing", landing)
        try:
            query(spark, small_dir).collect()
        finally:
            spark.conf.set(key, "true")
        rows = tables.with_stored_order(spark.read.parquet(base)).orderBy("row_ord").select("id", "row_ord.f").collect()
        ids = [r["id"] for r in rows]
        assert ids == sorted(ids, reverse=down) and len({r["f"] for r in rows}) > 1
