"""Table scans: S1-S4, S13 (S5: ``sources.chunks``).

Column selection and filters are expressed on the DataFrame so Catalyst pushes them into the
Parquet scan (``ReadSchema`` holds only the named columns; ``PushedFilters`` holds ``In``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.functions.scalars import AGENT_LABELS


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan, optionally under an explicit schema and pruned to ``columns``."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select(*columns) if columns else df


def read_baseline(spark: SparkSession, path: str, agents: Sequence[str] = AGENT_LABELS,
                  columns: Sequence[str] = ("repo_id", "user", "agent")) -> DataFrame:
    """S2 + F1: baseline PRs, three columns, agent filter inside the reader."""
    df = spark.read.parquet(path)
    return df.where(F.col("agent").isin(list(agents))).select(*columns)


def with_stored_order(df: DataFrame, name: str = "row_ord") -> DataFrame:
    """Stored row order of a Parquet scan as one sortable struct (part number, file name, row index).

    The reference's order-dependent rules ("first", "last") mean file order; this keeps them
    exact on a distributed scan. Never ``monotonically_increasing_id``. Spark's part files follow their
    number (``part-100000`` comes after ``part-99999``), other files their name.
    """
    file = F.col("_metadata.file_name")
    part = F.coalesce(F.regexp_extract(file, "^part-([0-9]+)", 1).try_cast("long"), F.lit(-1))
    return df.withColumn(name, F.struct(part.alias("n"), file.alias("f"), F.col("_metadata.row_index").alias("r")))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check by listing the path with the session's file systems (any scheme). Only a path that
    is not there counts as absent; other errors (permissions, network) are raised."""
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_optional(spark: SparkSession, path: str, schema: T.StructType,
                  required: bool = False) -> DataFrame | None:
    """Absent optional input -> None (the step is skipped); absent required -> error."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    if required:
        raise FileNotFoundError(f"{path} not found: run the collection first")
    return None


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A Parquet folder, or None when it does not exist or holds no file yet; other errors are raised."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
