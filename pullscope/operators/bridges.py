"""Ordered lists per key (A19) in bounded pages.

``collect_list`` of a key builds one array in one task, so a sha that a third of all pull requests hold
would sit in one cell. Here every list comes in pages of at most ``page_rows`` items. Keys are counted by hash bucket first.
Rows of a bucket with at most ``HOT_ROWS`` are dealt by key once, numbered and put in pages where they lie. For the others
a row's place in its list needs no task that sees the whole list: rows are written in files by ranges of (key, order) and sorted
in them, so a key's rows are consecutive in a file and follow each other from file to file; a place is the
row's index in its file plus what the files before hold of the key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pullscope.session import scratch_path
from pullscope.sources.tables import with_stored_order

PAGE_ROWS = 1000
#: Keys are counted in this many hash buckets; of one with more rows no key's rows are sorted by one task.
BUCKETS, HOT_ROWS = 1 << 15, 100_000


def ordered_places(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of ``df`` with ``place``: 0, 1, 2, ... within their ``key`` by ``order`` (rows that tie in all of
    ``order`` in any order). The sorted rows are written to the shared folder once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"ordered-{uuid.uuid4().hex[:12]}")
    df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).write.parquet(path)
    rows = with_stored_order(spark.read.schema(df.schema).parquet(path), "_at")
    rows = rows.withColumn("_file", F.struct("_at.n", "_at.f")).withColumn("_row", F.col("_at.r")).drop("_at")
    parts = rows.groupBy(F.col(key).alias("_key"), "_file").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file at most
    shift = parts.select("_key", "_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = rows[key].eqNullSafe(shift["_key"]) & (rows["_file"] == shift["_file"])
    return rows.join(shift, same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias("place"))


def _hot_buckets(df: DataFrame, bucket: Column, hot_rows: int) -> DataFrame:
    """The hash buckets with more than ``hot_rows`` rows, ``BUCKETS`` at most, stored."""
    path = scratch_path(df.sparkSession, f"hot-{uuid.uuid4().hex[:12]}")
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    sizes.where(F.col("n") > hot_rows).select("_bucket").coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema("_bucket long").parquet(path)


def ordered_lists(df: DataFrame, key: str, order: list[str], item: str, page_rows: int = PAGE_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, page, items): the key's ``item`` values by ``order``, ``page_rows`` to a page, pages from 0."""
    rows, bucket = df.select(*dict.fromkeys([key, *order, item])), F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    hot = _hot_buckets(rows, bucket, hot_rows)
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long") - 1
    if hot.isEmpty():
        return _paged(rows.withColumn("place", number), key, item, page_rows)
    rows, hot = rows.withColumn("_bucket", bucket), F.broadcast(hot)
    few, many = rows.join(hot, "_bucket", "left_anti"), rows.join(hot, "_bucket", "left_semi")
    return (_paged(few.withColumn("place", number), key, item, page_rows)
            .unionByName(_paged(ordered_places(many.drop("_bucket"), key, order), key, item, page_rows)))


def _paged(placed: DataFrame, key: str, item: str, page_rows: int) -> DataFrame:
    paged = placed.groupBy(key, F.expr(f"place div {page_rows}").alias("page"))
    pages = paged.agg(F.array_sort(F.collect_list(F.struct("place", F.col(item).alias("item")))).alias("_items"))
    return pages.select(key, "page", F.transform("_items", lambda x: x["item"]).alias("items"))
