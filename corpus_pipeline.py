"""The corpus pipeline: stages over the documents table, each from one operator.

Quality rules drop documents, line dedup takes repeated lines out of those left (and the documents of
which nothing is left), the Jaccard join keeps one document of each group, and packing puts the rest into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.llm import jaccard, lines, packing, quality
from cataloom.session import stage, staging_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those that lose all their words this way go, ``n_chars`` follows the text."""
    info = "line_dedup_"
    cleaned = lines.dedup_lines(docs, info=info, exact_chars=1)
    left = (F.col(info)["n_removed"] == 0) | F.col("text").rlike(lines.WORD)
    return cleaned.where(left).select(*(
        F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return jaccard.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    parts = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 0)
    parts = stage(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packing.best_fit(parts, ["doc_id", "piece"])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

#: learned rules, edit joins and token counts have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = staging_path(spark)
    for name, step in STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
