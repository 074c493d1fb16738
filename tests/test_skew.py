"""A key holding a third of the rows: AQE splits it (skew join) and results stay whole."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from pullscope.operators import details as det
from pullscope.operators import labels

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_user_label_join_is_split(spark):
    n = 30000
    prs = spark.range(0, n).select(F.col("id"),
                                   F.when(F.col("id") % 3 == 0, F.lit("bot"))
                                   .otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string"))).alias("user"))
    dim = spark.range(0, 997).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user"),
                                     F.lit("Devin").alias("_label")) \
        .unionByName(spark.createDataFrame([("bot", "Copilot")], "user string, _label string"))
    with conf(spark, SKEW_CONF):
        out = labels.label_author(prs, dim)
        rows = out.groupBy("agent").count().collect()
        agg = {r["agent"]: r["count"] for r in rows}
        assert agg == {"Copilot": n // 3, "Devin": n - n // 3}
        out2 = labels.label_author(prs, dim)
        out2.collect()
        plan = final_plan(out2)
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan


def test_hot_sha_fan_out_is_split_and_whole(spark):
    files = spark.range(0, 3).select(F.lit("hot").alias("sha"), F.concat(F.lit("f"), F.col("id").cast("string"))
                                     .alias("filename"))
    files = files.unionByName(spark.range(0, 2000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sha"),
                                                          F.lit("f").alias("filename")))
    bridge = spark.range(0, 6000).select(F.when(F.col("id") < 2000, F.lit("hot"))
                                         .otherwise(F.concat(F.lit("s"), (F.col("id") % 2000).cast("string")))
                                         .alias("sha"), F.col("id").alias("pr_id"))
    with conf(spark, SKEW_CONF):
        out = det.expand_to_prs(files, bridge)
        n = out.count()
        assert n == 3 * 2000 + 4000
        out.collect()
        plan = final_plan(out)
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
