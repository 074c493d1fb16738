"""Data-quality operators: Q1-Q6 (and A20 through ``repos.coverage``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pullscope.operators.labels import filter_created


def validate_month(prs: DataFrame, baseline_agent: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Q1: one-month slice checked against the baseline.

    Totals, agent PRs, repositories with agent PRs (ours / baseline), their overlap and the
    coverage of the baseline set (denominator at least 1), in one row.
    """
    month = filter_created(prs, date_from, date_to)
    ours = month.where(F.col("is_agent") & F.col("repo_id").isNotNull()).select(
        F.col("repo_id").alias("_k")).distinct().withColumn("_a", F.lit(True))
    theirs = baseline_agent.where(F.col("repo_id").isNotNull()).select(
        F.col("repo_id").alias("_k")).distinct().withColumn("_b", F.lit(True))
    sets = ours.join(theirs, "_k", "full_outer").agg(
        F.count_if(F.col("_a")).alias("repos_ours"), F.count_if(F.col("_b")).alias("repos_baseline"),
        F.count_if(F.col("_a") & F.col("_b")).alias("repo_overlap"))
    tot = month.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("is_agent")).alias("agents")).alias("t")).scalar()
    out = sets.select(tot["n"].alias("total_prs"), tot["agents"].alias("agent_prs"), "*")
    return out.withColumn("coverage_pct", F.col("repo_overlap") * 100.0
                          / F.greatest(F.col("repos_baseline"), F.lit(1)))


def conformance(spark: SparkSession, tables: Mapping[str, DataFrame],
                expected: Mapping[str, T.StructType], counts: bool = False) -> DataFrame:
    """Q2: per table and expected column: present?, actual type, expected type, whether they match.

    Works on schemas only (no data is read), unless ``counts`` asks for the values and nulls of each column: one
    partial aggregate per table."""
    rows = []
    for name, df in tables.items():
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        exp = {f.name: f.dataType.simpleString() for f in expected.get(name, T.StructType()).fields}
        for col in sorted(set(actual) | set(exp)):
            rows.append((name, col, col in actual, actual.get(col), exp.get(col),
                         actual.get(col) == exp.get(col)))
    schema = "table string, column string, present boolean, actual string, expected string, matches boolean"
    listed = spark.createDataFrame(rows, schema)
    if not counts:
        return listed
    held = None
    for name, df in tables.items():
        one = df.agg(*[F.struct(F.count(c).alias("vals"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(c) for c in df.columns])
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}.vals"), F.col(f"{c}.nulls")) for c in df.columns]))
        part = one.select(F.lit(name).alias("table"), cells.alias("c")).select("table", "c.*")
        held = part if held is None else held.unionByName(part)
    return listed.join(held, ["table", "column"], "left").withColumnRenamed("vals", "values")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Q5: stop when a required input is empty (one row is read, not the table)."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}: cannot proceed")
    return df


def quarantine(df: DataFrame, bad: F.Column) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad) by a predicate; bad rows go to a dead-letter table."""
    flag = F.coalesce(bad, F.lit(False))
    return df.where(~flag), df.where(flag)
