"""The corpus pipeline: five stages over ``documents``, each written as Parquet before the next reads it.

1. quality      documents that the classifier rejects go
2. line_dedup   boilerplate lines go where they do not stand first; documents left without any line go
3. near_dedup   of each group of SimHash near-duplicates the document with the smallest id stays
4. decontaminate documents that hold a passage of the benchmark go
5. packing      what is left is packed into sequences of 2,048 tokens (one row per piece)

Stages 1 to 4 return the columns they were given.  SQL cannot express the first
stage, so ``ORACLE_SQL`` is None; tests hold each stage against brute force.

Null texts: the classifier scores them as empty texts; stages 2 to 4 keep them (3: as
one group with the empty ones); packing gives them their closing id.  Extra columns
go through untouched.  An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontaminate, line_dedup, packing, quality, simhash
from candlewick.llm.common import shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    removed = "_lines_removed"
    while removed in docs.columns:
        removed += "_"
    out = line_dedup.dedup_lines(docs, removed_col=removed)
    out = out.where((F.col(removed) == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.drop(removed)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is a Parquet folder beside the shared checkpoints."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "corpus-pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
