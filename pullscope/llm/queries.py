"""Registered queries of the operators: each applies one, with production parameters, to its
whole table and returns its full result with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.llm.ans import token_table
from pullscope.llm.decontaminate import leaks
from pullscope.llm.embedding_dedup import near_vectors
from pullscope.llm.exact import exact_dedup
from pullscope.llm.hard_negatives import hard_negatives
from pullscope.llm.langid import identify
from pullscope.llm.minhash import near_dedup
from pullscope.llm.mixing import mix
from pullscope.llm.pii import personal_data
from pullscope.llm.quality import quality
from pullscope.llm.runs import looped, periodic_runs
from pullscope.llm.substring import substring_dedup
from pullscope.llm.text import table
from pullscope.llm.toxicity import toxicity


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "agreeing", "word_start")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), moved.alias("label"), "embedding")
    return hard_negatives(rows, F.col("id") % 50 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents"), change=looped)
    return runs.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash_near_dedup, op2_toxicity, op3_token_output, op4_decontamination,
                                    op5_language_id, op6_pii, op7_substring_dedup, op8_quality, op9_mixing,
                                    op10_exact_dedup, op11_embedding_near_dedup, op12_hard_negatives, op13_periodic_runs)}
