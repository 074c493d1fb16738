"""The corpus pipeline: documents to token files, in five stages of the operators in ``pullscope.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``. Stages do not
crash on null or empty texts, null ids, repeated rows, empty tables or further columns; each operator's
docstring says what such rows give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullscope.llm.ans import token_table
from pullscope.llm.decontaminate import clean_documents
from pullscope.llm.minhash import one_of_each
from pullscope.llm.mixing import mixed_documents
from pullscope.llm.text import fresh, new_folder, split_share, stored, table
from pullscope.llm.toxicity import THRESHOLD, scored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold (learned as in ``op2``)."""
    score = fresh(docs, "score")[0]
    found = scored(docs, table(spark, sf_dir, "labels"), split_share(F.col("doc_id"), 3) != 1, score)
    return found.where(F.col(score) < THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in ascending doc_id order, described per document from the files."""
    return token_table(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("tokens", tokens)]

#: SQL can express neither the classifier nor the tokenizer: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    folder, docs = new_folder(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
