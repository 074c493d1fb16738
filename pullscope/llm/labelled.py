"""The labelled documents that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(labels: DataFrame, label: str, learn) -> tuple[DataFrame, dict[int, int]]:
    """The ids that the condition ``learn`` on doc_id admits with their label 0 / 1 (``_id``, ``label``), and how many
    there are per label. Null ids and other labels teach nothing; of several labels of one id the largest counts."""
    ids = F.col("doc_id").cast("long")
    rows = (labels.select(ids.alias("_id"), F.col(label).cast("int").alias("label"), learn.alias("learn"))
            .where("learn and _id is not null and label in (0, 1)").groupBy("_id").agg(F.max("label").alias("label")))
    return rows, {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def one_per_id(rows: DataFrame, hashed: str, *columns: str) -> DataFrame:
    """Of several rows with one ``_id`` that with the least ``hashed`` (the hash of its text), with ``label`` and ``columns``."""
    one = F.min(F.struct(hashed, *columns)).alias("one")
    return rows.groupBy("_id").agg(one, F.max("label").alias("label")).select("_id", "label", *[F.col(f"one.{c}").alias(c) for c in columns])
