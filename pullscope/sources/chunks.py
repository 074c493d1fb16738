"""Chunk store K2 / K3 / K4 / S5: a key's rows replaced as a whole, merged incrementally.

The collector writes the rows of some keys (repositories) at a time, a re-run replaces them, and the
merge makes one table of all. A file or directory per key does not scale with the number of keys, so keys
are dealt by hash into a fixed number of buckets:

    <path>/data/run=<id>/bucket=<b>/...   the whole rows of every bucket that the run touched
    <path>/marks/run=<id>/...             (seq, bucket, rows) of the touched buckets, written last

A run reads the current rows of the buckets it touches, drops the rows of its own keys, adds the new ones,
and writes those buckets anew; other buckets stay where they are. The marks are the commit: a run that
died before them is not seen, and the run before it is still whole. A bucket's newest marked run is its
current version, so no stale rows of a rewritten key are ever read (B15), also when the key has no row left.
One writer at a time is assumed; readers need no lock.

The merged table is partitioned by bucket. A merge compares the marks with those it merged last, reads the
changed buckets only and replaces their partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.sources.tables import read_or_none

#: Buckets of a new store. Size it so that a bucket fits some tasks: 100 TB in 16384 buckets are 6 GB each.
BUCKETS = 32
_MARKS = "seq long, bucket int, rows long, buckets int"


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def current_marks(spark: SparkSession, path: str) -> DataFrame:
    """Current version of each bucket: (bucket, seq, run, rows); one row per bucket, no rows without a store."""
    marks = read_or_none(spark, f"{path}/marks", f"{_MARKS}, run string")
    if marks is None:
        return spark.createDataFrame([], "bucket int, seq long, run string, rows long, buckets int")
    newest = F.max(F.struct("seq", "run", "rows", "buckets")).alias("m")
    return marks.groupBy("bucket").agg(newest).select("bucket", "m.seq", "m.run", "m.rows", "m.buckets")


def _rows_of(spark: SparkSession, path: str, marks: Iterable, schema: T.StructType) -> DataFrame:
    """The rows of some current buckets, with their ``bucket``. Paths are bounded by the number of buckets."""
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    paths = [f"{path}/data/run={m['run']}/bucket={m['bucket']}" for m in marks if m["rows"]]
    if not paths:
        return spark.createDataFrame([], whole)
    data = T.StructType([*whole.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(data).option("basePath", f"{path}/data").parquet(*paths).drop("run")


def read_chunks(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current rows of all keys, under an explicit schema (never inferred: a chunk holding only empty
    commits would type ``filename`` as null). No store: no rows (K4)."""
    return _rows_of(spark, path, current_marks(spark, path).collect(), schema).drop("bucket")


def write_chunks(df: DataFrame, path: str, key: str = "repo_name", keys: DataFrame | None = None,
                 buckets: int | None = None) -> int:
    """K2: replace the rows of ``keys`` (a frame with the column ``key``; by default the keys of ``df``) by
    those of ``df``; returns the number of buckets written.

    A key of ``keys`` without rows in ``df`` has no rows afterwards. Null is a key like others. Rows are
    gathered by bucket with a rebalance hint, so a hot key becomes several tasks and files. The number of buckets is
    fixed by the first run. ``df`` is read once for its keys (if ``keys`` is not given) and once for its rows.
    """
    spark, schema = df.sparkSession, df.schema
    marks = {m["bucket"]: m for m in current_marks(spark, path).collect()}
    fixed = next(iter(marks.values()))["buckets"] if marks else None
    if fixed and buckets and buckets != fixed:
        raise ValueError(f"the store at {path} has {fixed} buckets, not {buckets}")
    count = fixed or buckets or BUCKETS
    names = (df if keys is None else keys).select(F.col(key).alias("_key")).distinct()
    touched = [r[0] for r in names.select(bucket_of("_key", count)).distinct().collect()]  # at most one per bucket
    if not touched:
        return 0
    old = _rows_of(spark, path, [marks[b] for b in touched if b in marks], schema)
    rows = df.withColumn("bucket", bucket_of(key, count))
    if any(marks[b]["rows"] for b in touched if b in marks):
        rows = rows.unionByName(old.join(names, old[key].eqNullSafe(names["_key"]), "left_anti"))
    seq = max((m["seq"] for m in marks.values()), default=0) + 1
    run = f"{seq:09d}-{uuid.uuid4().hex[:8]}"
    data = f"{path}/data/run={run}"
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(data)
    written = read_or_none(spark, data, "bucket int")  # counts come from the footers
    held = {r["bucket"]: r["count"] for r in written.groupBy("bucket").count().collect()} if written is not None else {}
    new = spark.createDataFrame([(seq, b, held.get(b, 0), count) for b in touched], _MARKS)
    new.coalesce(1).write.parquet(f"{path}/marks/run={run}")
    return len(touched)


@dataclass
class Merged:
    """What a merge did: rows of the whole table, buckets read and replaced, and buckets in all."""

    rows: int
    changed: int
    buckets: int


def merge_chunks(spark: SparkSession, path: str, table: str, schema: T.StructType) -> Merged:
    """K3/K4: bring the merged table up to date with the chunk store and return its number of rows.

    Only buckets whose version is not the merged one are read; their partitions are replaced by a dynamic overwrite. What was
    merged is recorded after the table is written, so a merge that died is repeated. The row count comes from the
    marks. Without chunks the table is empty and typed.
    """
    marks = current_marks(spark, path).collect()
    seen = read_or_none(spark, f"{table}.merged", "bucket int, run string")
    done = {r["bucket"]: r["run"] for r in seen.collect()} if seen is not None else {}
    changed = [m for m in marks if done.get(m["bucket"]) != m["run"]]
    full = [m for m in changed if m["rows"]]
    if full or (not marks and not done):
        (_rows_of(spark, path, full, schema).hint("rebalance", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(table))
    for m in changed:
        if not m["rows"]:  # a bucket that lost its last row; at most one small write per bucket
            spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{table}/bucket={m['bucket']}")
    if changed:
        state = spark.createDataFrame([(m["bucket"], m["run"]) for m in marks], "bucket int, run string")
        state.coalesce(1).write.mode("overwrite").parquet(f"{table}.merged")
    return Merged(sum(m["rows"] for m in marks), len(changed), len(marks))


def read_merged(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The merged table's rows; an empty frame where nothing was ever merged."""
    found = read_or_none(spark, table, schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)
