"""The operators applied to the test tables, with the parameters of a production run."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decision_lists
from .centroids import cluster
from .common import ship
from .exact_dedup import exact_duplicates
from .lengths import length_histogram, suffix_sums
from .line_templates import drop_recurring_lines
from .minhash import near_duplicates
from .mixing import mix
from .neighbours import nearest
from .packing import pack
from .quality import classify
from .quotes import link_conversations
from .spelling import spelling_variants, word_counts
from .url_filter import judge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"))


@_query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


@_query
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op5_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_conversations(_table(spark, sf_dir, "conversations"))


@_query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sums(length_histogram(_table(spark, sf_dir, "documents")))


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(documents, dropped_column="dropped").select(
        "doc_id",
        F.size("dropped").alias("n_dropped"),
        F.length("text").alias("points_left"),
        F.md5("text").alias("text_md5"),
    )


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@_query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(_table(spark, sf_dir, "documents"), slip_every=199)
    return spelling_variants(counts)


@_query
def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_lists.fit(documents, _table(spark, sf_dir, "labels"))
    return decision_lists.judge(documents, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(_table(spark, sf_dir, "embeddings")).drop("compared")
