"""Incremental state for batch runs: S12, K7 (streams keep theirs in the checkpoint).

State rows are ``(phase, key, kind, detail, run_id)`` with ``kind`` in done / error / skipped /
missing. Each save writes a new ``run=<id>`` directory and then a ``done=<id>`` marker; readers
take the newest run that has one, so a crash mid-write leaves the previous state intact (the reference replaced a JSON file
atomically). Corrupt or absent state means start fresh.
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.schemas import STATE
from pullscope.sources.tables import read_or_none

#: Errors of files that are damaged or gone.
UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "PATH_NOT_FOUND")
#: Newest versions that are tried when some can't be read.
KEPT = 20


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Saved versions, newest first: by sequence number, not by the text of the run id."""
    done = read_or_none(spark, f"{path}/done=*", "saved string, seq long")
    return [] if done is None else [r["saved"] for r in done.orderBy(F.desc("seq"), F.desc("saved")).limit(KEPT).collect()]


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state, read from its own folder only (an empty save is a state too).

    Absent state is empty. A version that can't be read counts as a whole as if it had not been saved: the one before it
    holds, and collection starts fresh where none can be read.
    """
    for version in _versions(spark, path):
        state = spark.read.schema(STATE).parquet(f"{path}/run={version}")
        try:
            state.agg(F.bit_xor(F.xxhash64(*STATE.names))).collect()  # every column of every file can be read
            return state
        except (PySparkException, Py4JJavaError) as e:
            if not any(x in str(e) for x in UNREADABLE):
                raise
    return empty_state(spark)


def write_state(state: DataFrame, path: str, run_id: str | None = None) -> str:
    """K7: save a new state version whole, then a small marker that it is complete. Versions have rising sequence
    numbers, whatever their run ids are."""
    spark = state.sparkSession
    done = read_or_none(spark, f"{path}/done=*", "saved string, seq long")
    last = done.agg(F.max("seq")).first()[0] if done is not None else None
    rid = run_id or time.strftime("%Y%m%dT%H%M%S") + f"{time.time() % 1:.6f}"[1:]
    state.withColumn("run_id", F.lit(rid)).write.mode("overwrite").parquet(f"{path}/run={rid}")
    mark = spark.range(1).select(F.lit(rid).alias("saved"), F.lit((last or 0) + 1).cast("long").alias("seq"))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/done={rid}")
    return rid


def read_imported_state(spark: SparkSession, path: str, phase: str) -> DataFrame:
    """S12 for JSON state files of the reference's shape
    (``done_repos``/``errors``/``skipped`` or ``done_repos``/``error_repos``/``missing_shas``).

    Malformed files are ignored (start fresh for them)."""
    ddl = ("done_repos ARRAY<STRING>, errors ARRAY<STRING>, skipped ARRAY<STRING>, "
           "error_repos ARRAY<STRING>, missing_shas ARRAY<STRING>, done_pr_ids ARRAY<STRING>, "
           "_corrupt_record STRING")
    raw = (spark.read.schema(ddl).option("mode", "PERMISSIVE").option("multiLine", True)
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    ok = raw.where(F.col("_corrupt_record").isNull())
    parts = []
    for col, kind in [("done_repos", "done"), ("done_pr_ids", "done"), ("errors", "error"),
                      ("error_repos", "error"), ("skipped", "skipped"), ("missing_shas", "missing")]:
        parts.append(ok.select(F.lit(phase).alias("phase"), F.explode(col).alias("key"),
                               F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("detail"),
                               F.lit("imported").alias("run_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def remaining(keys: DataFrame, state: DataFrame, key: str = "key") -> DataFrame:
    """Keys not yet done."""
    done = state.where(F.col("kind") == "done").select(F.col("key").alias(key))
    return keys.join(done, key, "left_anti")


def retry_set(keys: DataFrame, state: DataFrame, key: str = "key") -> DataFrame:
    """Keys recorded as errors, for the single retry pass."""
    err = state.where(F.col("kind") == "error").select(F.col("key").alias(key))
    return keys.join(err, key, "left_semi")
