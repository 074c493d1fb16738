"""Sinks K1, K5, K6, K8, K9: Parquet tables, CSV, samples, report text, manifest (chunks: ``sources.chunks``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                sort_by: str | None = None, row_group_bytes: int | None = None) -> None:
    """K1: Parquet, replaced as a whole. With ``sort_by`` (e.g. ``created_at``) the table is clustered: rows are
    dealt to files by ranges of that column and sorted within them, so that files and row groups hold
    narrow ranges and a scan with a window on it skips the others by their statistics (F3's early stop).
    ``row_group_bytes`` makes row groups smaller than the default."""
    if sort_by:
        df = df.repartitionByRange(F.col(sort_by)).sortWithinPartitions(sort_by)
    w = df.write.mode(mode)
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", 1000)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """K5: CSV with header. ``single_file`` only for outputs of bounded size (one row per
    repository export is still data-sized: prefer several files)."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_samples(tables: Mapping[str, DataFrame], path: str, n: int = 20, seed: int = 42,
                  keys: Mapping[str, list[str]] | None = None) -> None:
    """K6: up to ``n`` sampled rows per table as CSV (L4)."""
    from pullscope.operators.sampling import sample_n
    for name, df in tables.items():
        key = (keys or {}).get(name) or [df.columns[0]]
        write_csv(sample_n(df, n, seed, key), f"{path}/{name}_sample", single_file=True)


def write_report(report: DataFrame, path: str) -> None:
    """K8: the long-format report table as Parquet, and its text lines in order, made from the
    stored table (a few hundred lines, so one file)."""
    report.write.mode("overwrite").parquet(path + "/table")
    back = report.sparkSession.read.parquet(path + "/table")
    keys = [c for c in ("line", "section", "grp", "metric") if c in back.columns]
    back.orderBy(*keys).select(F.col("text").alias("value")).coalesce(1).write.mode("overwrite").text(path + "/text")


def manifest_files(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """K9: (table, file, rows, bytes) of every file of the written tables. Rows come from the footers (no
    column is read), bytes from the listing."""
    parts = []
    for name, p in paths.items():
        file = F.regexp_replace("_metadata.file_path", "^.*/", "").alias("file")
        rows = spark.read.parquet(p).select(file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
        listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                  .load(p).select(F.regexp_replace("path", "^.*/", "").alias("file"), F.col("length").alias("bytes")))
        parts.append(listed.join(rows, "file", "left").select(F.lit(name).alias("table"), "file",
                                                              F.coalesce("rows", F.lit(0)).alias("rows"), "bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """K9: per written table its rows, number of files, columns (names in order) and bytes on storage."""
    schemas = {name: ",".join(spark.read.parquet(p).columns) for name, p in paths.items()}
    columns = spark.createDataFrame(sorted(schemas.items()), "table string, columns string")
    sums = (manifest_files(spark, paths).groupBy("table")
            .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")))
    return columns.join(sums, "table", "left").select("table", F.coalesce("rows", F.lit(0)).alias("rows"), "columns",
                                                      F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))
