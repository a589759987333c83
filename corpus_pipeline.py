"""From documents to tokens: quality rules, near-dedup, passage dedup, decontamination, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens.llm import bpe, decontaminate, line_quality, near_dup, substring_dedup
from staylens.llm.storage import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines are taken out of the others."""
    return line_quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return near_dup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are taken out of the later ones."""
    return substring_dedup.cut(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows are taken out."""
    return decontaminate.cut(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids and their number."""
    return bpe.encode(docs.select("doc_id", "text")).selectExpr("doc_id", "token_ids", "size(token_ids) AS n_tokens")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("bpe tokens", tokens),
]

#: Seeds, chains and signatures are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
