"""Ordered lists in bounded pages, and scans of clustered tables."""

import random
import tempfile

from pyspark.sql import functions as F

from pullscope.operators.bridges import ordered_lists, ordered_places
from pullscope.operators.labels import filter_created
from pullscope.sources.sinks import write_table


def test_pages_are_the_ordered_list_of_each_key(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "c", None]), rng.randrange(50), i) for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "sha string, seq int, pr_id long").repartition(7)
    got = {}
    for r in ordered_lists(df, "sha", ["seq", "pr_id"], "pr_id", page_rows=64).collect():
        assert len(r["items"]) <= 64
        got.setdefault(r["sha"], {})[r["page"]] = r["items"]
    want = {}
    for sha, _seq, i in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        want.setdefault(sha, []).append(i)
    assert set(got) == set(want)
    for sha, pages in got.items():
        assert sorted(pages) == list(range(len(pages)))
        assert [x for k in sorted(pages) for x in pages[k]] == want[sha]


def test_no_task_sorts_or_collects_a_hot_key(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("sha"),
                                    (F.col("id") * 7919 % 40_000).alias("pr_id"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordered_places(df, "sha", ["pr_id"])
        files = placed.where("sha = 'hot'").select(F.col("place"), F.spark_partition_id().alias("p"))
        assert files.select("p").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    hot = [r["place"] for r in placed.where("sha = 'hot'").orderBy("pr_id").select("place").collect()]
    assert hot == list(range(len(hot))) and len(hot) == 13_334


def test_empty_lists(spark):
    assert ordered_lists(spark.createDataFrame([], "k string, v long"), "k", ["v"], "v").count() == 0


def _scanned(df):
    """Rows that the file scan of the executed plan put out (groups that are skipped put out none)."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    todo, rows = [plan], 0
    while todo:
        node = todo.pop()
        if "FileSourceScanExec" in node.getClass().getName():
            rows += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_a_window_on_a_clustered_table_reads_few_row_groups(spark):
    base = tempfile.mkdtemp(prefix="ps-f3-")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7919 % 1000).cast("int")), "yyyy-MM-dd'T'00:00:00'Z'")
    prs = spark.range(100_000).select("id", day.alias("created_at"), F.sha1(F.col("id").cast("string")).alias("title"))
    write_table(prs, f"{base}/plain", row_group_bytes=1 << 16)
    write_table(prs, f"{base}/clustered", sort_by="created_at", row_group_bytes=1 << 16)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for name in ("plain", "clustered"):
            got = filter_created(spark.read.parquet(f"{base}/{name}"), "2021-01-01", "2021-01-31")
            assert got.count() == 3100
            read[name] = _scanned(got)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert read["plain"] == 100_000 and read["clustered"] < 15_000
