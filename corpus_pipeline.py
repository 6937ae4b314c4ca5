"""From raw documents to packed training sequences, in five stages.

Each stage gets what its predecessor wrote and returns the documents it keeps, with all their columns;
the last one returns the pieces of the packed sequences.
"""

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import quality
from martwright.llm.common import fresh, keep, ship
from martwright.llm.line_templates import drop_recurring_lines
from martwright.llm.minhash import one_of_each_group
from martwright.llm.mixing import mixed_documents
from martwright.llm.packing import pack

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Cube sampling, the network and the tokenizer are not SQL; tests compare run() with the stages'
# brute-force versions instead.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score below the threshold."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    name = fresh("quality")
    scored = quality.score(docs, model, name=name)
    return scored.filter(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines of recurring templates, and documents that had no other line."""
    ship(spark)
    dropped = fresh("dropped")
    left = drop_recurring_lines(docs, dropped_column=dropped)
    emptied = (F.size(dropped) > 0) & ~F.rlike(F.col("text"), F.lit(r"[^\x20\x09-\x0D]"))
    left = left.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        shorter = F.size(dropped) > 0
        left = left.withColumn(
            "n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    ship(spark)
    return one_of_each_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents so that the sources have their target shares."""
    ship(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences."""
    ship(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
