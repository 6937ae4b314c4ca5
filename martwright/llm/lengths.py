"""Token counts of a corpus as an exact histogram of encoded lengths.

Each Arrow batch leaves its worker as a small histogram, so what is shuffled does not grow with the
texts but with the number of different lengths. Suffix sums over the histogram answer, for every
context limit, how many documents and tokens are longer, what a quantile is, and how many tokens
remain when every document is cut at the limit.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep
from .tokens import batches, default_path

# Lengths per block of the suffix sums.
BLOCK = 256


def length_histogram(
    docs: DataFrame, text_column: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """``length, documents``: how many documents encode to so many ids. A null text is empty."""
    path = tokenizer or default_path()

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (offsets, _) in batches(path, source, "text"):
            lengths, documents = np.unique(np.diff(offsets), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int64()), pa.array(documents, pa.int64())],
                ["length", "documents"],
            )

    counted = docs.select(F.col(text_column).alias("text")).mapInArrow(
        count, "length long, documents long"
    )
    # Stored, because the suffix sums read it more than once and the texts should be encoded once.
    return keep(counted.groupBy("length").agg(F.sum("documents").alias("documents")), "lengths")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per length that occurs, with the totals for a context limit of that length:

    ``documents`` and ``tokens`` of exactly this length; ``documents_at_least`` and
    ``tokens_at_least``; ``documents_at_most``; ``truncated_tokens``, the corpus cut at this limit;
    ``quantile``, the share of documents that fit. Sums run inside blocks of lengths, and over one
    row per block; the number of blocks is the longest length over 256, whatever the corpus.
    """
    rows = histogram.select(
        "length",
        "documents",
        (F.col("length") * F.col("documents")).alias("tokens"),
        F.floor(F.col("length") / BLOCK).alias("block"),
    )
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    blocks = (
        rows.groupBy("block")
        .agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
        .select(
            F.col("block").alias("of"),
            F.coalesce(F.sum("d").over(above), F.lit(0)).alias("documents_above"),
            F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("d").over(every).alias("all_documents"),
            F.sum("t").over(every).alias("all_tokens"),
        )
    )
    inside = (
        Window.partitionBy("block")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.join(blocks, rows["block"] == blocks["of"]).select(
        "length",
        "documents",
        "tokens",
        (F.sum("documents").over(inside) + F.col("documents_above")).alias("documents_at_least"),
        (F.sum("tokens").over(inside) + F.col("tokens_above")).alias("tokens_at_least"),
        "all_documents",
        "all_tokens",
    )
    fit = F.col("all_documents") - F.col("documents_at_least") + F.col("documents")
    cut = F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("documents_at_least")
    return summed.select(
        "length",
        "documents",
        "tokens",
        "documents_at_least",
        "tokens_at_least",
        fit.alias("documents_at_most"),
        cut.alias("truncated_tokens"),
        (fit / F.col("all_documents")).alias("quantile"),
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row, ``tokens``: the corpus when every document is cut at ``limit``, which need not be a
    length that occurs. An empty corpus has 0 tokens."""
    longer = F.col("length") > limit

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return sums.agg(
        (
            total(F.when(~longer, F.col("tokens"))) + total(F.when(longer, F.col("documents"))) * limit
        ).alias("tokens")
    )


def quantile_length(sums: DataFrame, share: float) -> DataFrame:
    """One row, ``length``: the smallest limit that at least ``share`` of the documents fit."""
    return sums.filter(F.col("quantile") >= share).agg(F.min("length").alias("length"))
