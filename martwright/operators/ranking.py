"""First rows per group."""

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows of a group that the last step ranks at most, as multiples of n: one lot for each part.
PARTS = 32


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int = 1,
    rank_column: str | None = None, parts: int = PARTS,
) -> DataFrame:
    """The first ``n`` rows of each group by ``row_number``; the rank is kept on request.

    For ``n`` up to the engine's limit (``spark.sql.optimizer.windowGroupLimitThreshold``, 1000)
    the rank filter becomes a group limit that runs before the shuffle, so a group sends at most
    ``n`` rows per task. Beyond it two steps do the same: a group is dealt into parts by the task that
    read a row, each part ranks its own rows, and the first ``n`` of all parts are ranked together. So no task
    ever sorts a whole hot group, and the last one at most ``parts`` times ``n`` rows of it. Give an
    order without ties for a repeatable result.
    """
    rank = rank_column or f"rank_{uuid.uuid4().hex}"
    window = Window.partitionBy(*group).orderBy(*order)
    if n > _group_limit(df):
        part, place = f"part_{uuid.uuid4().hex}", f"place_{uuid.uuid4().hex}"
        own = Window.partitionBy(*group, part).orderBy(*order)
        df = (
            df.withColumn(part, F.spark_partition_id() % parts)
            .withColumn(place, F.row_number().over(own))
            .filter(F.col(place) <= n)
            .drop(part, place)
        )
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked if rank_column else ranked.drop(rank)


def _group_limit(df: DataFrame) -> int:
    """The largest rank that the engine cuts before a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def join_top(totals: DataFrame, ranked: DataFrame, on: str, rank_column: str) -> DataFrame:
    """Attach the first-ranked row of each group to that group's totals."""
    best = ranked.filter(F.col(rank_column) == 1).drop(rank_column)
    return totals.join(best, on, "inner")
