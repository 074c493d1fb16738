"""Chunk store: whole replacement of keys, incremental merge, crash before the marks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.sources import chunks

SCHEMA = T.StructType([T.StructField("repo_name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("patch", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(k, n, None) for k, n in rows], SCHEMA)


def held(df):
    return sorted(((r["repo_name"], r["n"]) for r in df.collect()), key=repr)


def test_keys_are_replaced_whole_and_only_changed_buckets_are_merged(spark):
    base = tempfile.mkdtemp(prefix="ps-chunks-")
    store, table = f"{base}/chunks", f"{base}/table"
    first = [(f"o/{i}", j) for i in range(200) for j in range(3)] + [(None, 7)]
    assert chunks.write_chunks(frame(spark, first), store, buckets=16) == 16
    assert held(chunks.read_chunks(spark, store, SCHEMA)) == sorted(first, key=repr)
    merged = chunks.merge_chunks(spark, store, table, SCHEMA)
    assert (merged.rows, merged.changed, merged.buckets) == (601, 16, 16)
    assert held(chunks.read_merged(spark, table, SCHEMA)) == sorted(first, key=repr)
    assert len([n for n in os.listdir(table) if n.startswith("bucket=")]) == 16  # not a directory per key
    # fewer rows of one key, other rows of null, none of another
    touched = chunks.write_chunks(frame(spark, [("o/5", 99), (None, 8)]), store,
                                  keys=spark.createDataFrame([("o/5",), ("o/6",), (None,)], "repo_name string"))
    assert touched <= 3
    want = sorted([r for r in first if r[0] not in ("o/5", "o/6", None)] + [("o/5", 99), (None, 8)], key=repr)
    assert held(chunks.read_chunks(spark, store, SCHEMA)) == want
    merged = chunks.merge_chunks(spark, store, table, SCHEMA)
    assert (merged.rows, merged.changed) == (len(want), touched)
    assert held(chunks.read_merged(spark, table, SCHEMA)) == want
    assert chunks.merge_chunks(spark, store, table, SCHEMA).changed == 0
    with pytest.raises(ValueError):
        chunks.write_chunks(frame(spark, [("x", 1)]), store, buckets=8)


def test_a_bucket_that_loses_its_last_row(spark):
    base = tempfile.mkdtemp(prefix="ps-chunks-")
    store, table = f"{base}/chunks", f"{base}/table"
    chunks.write_chunks(frame(spark, [("a", 1), ("b", 2)]), store, buckets=1000)
    chunks.merge_chunks(spark, store, table, SCHEMA)
    chunks.write_chunks(frame(spark, []), store, keys=spark.createDataFrame([("a",)], "repo_name string"))
    assert held(chunks.read_chunks(spark, store, SCHEMA)) == [("b", 2)]
    assert chunks.merge_chunks(spark, store, table, SCHEMA).rows == 1
    assert held(chunks.read_merged(spark, table, SCHEMA)) == [("b", 2)]
    chunks.write_chunks(frame(spark, [("a", 3)]), store)
    chunks.merge_chunks(spark, store, table, SCHEMA)
    assert held(chunks.read_merged(spark, table, SCHEMA)) == [("a", 3), ("b", 2)]


def test_a_run_without_marks_is_not_seen(spark):
    base = tempfile.mkdtemp(prefix="ps-chunks-")
    chunks.write_chunks(frame(spark, [("a", 1), ("b", 2)]), base, buckets=4)
    # a run that died after its data and before its marks
    half = frame(spark, [("a", 5)]).withColumn("bucket", chunks.bucket_of("repo_name", 4))
    half.write.partitionBy("bucket").parquet(f"{base}/data/run=000000002-dead")
    assert held(chunks.read_chunks(spark, base, SCHEMA)) == [("a", 1), ("b", 2)]
    chunks.write_chunks(frame(spark, [("a", 6)]), base)
    assert held(chunks.read_chunks(spark, base, SCHEMA)) == [("a", 6), ("b", 2)]


def test_no_chunks_give_an_empty_typed_table(spark):
    base = tempfile.mkdtemp(prefix="ps-chunks-")
    assert chunks.read_chunks(spark, f"{base}/none", SCHEMA).schema == SCHEMA
    assert chunks.merge_chunks(spark, f"{base}/none", f"{base}/table", SCHEMA).rows == 0
    got = chunks.read_merged(spark, f"{base}/table", SCHEMA)
    assert got.count() == 0 and got.schema == SCHEMA
    assert chunks.write_chunks(frame(spark, []), f"{base}/none") == 0


def test_a_hot_key_is_written_by_several_tasks(spark):
    base = tempfile.mkdtemp(prefix="ps-chunks-")
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
                                     .alias("repo_name"), F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 512).alias("patch"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        chunks.write_chunks(df, base, buckets=8)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = spark.range(1).select(chunks.bucket_of(F.lit("hot"), 8)).first()[0]
    run = os.listdir(f"{base}/data")[0]
    assert sum(n.endswith(".parquet") for n in os.listdir(f"{base}/data/{run}/bucket={hot}")) > 2
    assert chunks.read_chunks(spark, base, SCHEMA).where("repo_name = 'hot'").count() == 66_667
