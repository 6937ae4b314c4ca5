"""Connected components by alternating large and small stars.

Every round rewires each node's links to the smallest node it knows. Nothing is collected: a node with
any number of links is a minimum that combines before the shuffle, and a join that adaptive execution
may split. Each round is written to the shared folder, which cuts the lineage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has a link; the component is its smallest node.

    Links have long ids, no nulls; loops and repeated links do no harm.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    edges = keep(
        links.filter(F.col(a) != F.col(b))
        .select(high.alias("high"), low.alias("low"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        edges = keep(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger node has one link, to a node that is nowhere the larger one."""
    roles = edges.select(
        F.col("high").alias("node"), F.lit(1).alias("as_high"), F.lit(0).alias("as_low")
    ).unionByName(
        edges.select(F.col("low").alias("node"), F.lit(0).alias("as_high"), F.lit(1).alias("as_low"))
    )
    counts = roles.groupBy("node").agg(F.sum("as_high").alias("high"), F.max("as_low").alias("low"))
    return counts.filter((F.col("high") > 1) | ((F.col("high") > 0) & (F.col("low") > 0))).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(
        edges.select(F.col("low").alias("high"), F.col("high").alias("low"))
    ).select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select(
        F.col("node").alias("of"), F.least("node", "least").alias("least")
    )
    return (
        both.filter(F.col("other") > F.col("node"))
        .join(least, F.col("node") == F.col("of"))
        .select(F.col("other").alias("high"), F.col("least").alias("low"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select(F.col("high").alias("of"), "least")
    joined = edges.join(least, F.col("high") == F.col("of"))
    return (
        joined.select(
            F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("high"),
            F.col("least").alias("low"),
        )
        .filter(F.col("high") != F.col("low"))
        .distinct()
    )
