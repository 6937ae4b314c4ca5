"""Mixing sources to target weights by balanced sampling with the cube method.

A source whose target is r times its size keeps floor(r) copies of every document and samples the
rest: each document starts with the inclusion probability r - floor(r). The flight moves
probabilities along the null space of the constraints, so that while documents become 0 or 1 the
expected number of documents and of words of the source stay exactly what they were. With two
constraints any three undecided documents have such a direction, so a bucket leaves two undecided
documents per source, and ten more that it holds back for the landing. Those of 64 buckets continue
together, then those of 64 such groups, until a dozen per source are left in the whole corpus: the
landing decides them so that the words come nearest.

Buckets come from the document ids and the number of documents, and their draws from the seed, so
reruns agree whatever the cluster does.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, keep, numbered, word_count

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST = 2.0
# Documents per bucket of the flight, in expectation.
BUCKET_ROWS = 4096
FAN_IN_BITS = 6
# Undecided documents per source that every group keeps for the landing, besides the last two.
HELD = 10
# Identical rows travel as one row for so many of them, so that they spread over buckets.
BLOCK_ROWS = BUCKET_ROWS // 16
SNAP = 1e-9

UNITS = (
    "doc_id long, no_id boolean, text_key long, source string, size long, source_size long, target double, "
    "base int, bucket long, p double"
)


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: float = MOST,
) -> DataFrame:
    """``source, source_size, target`` of a table ``source, size``.

    Sources in code point order, null last, take the weights in turn and share ``total_share`` of
    all sizes. A target stops at ``most`` times its source's size, and what it would have had above
    that goes to the others by weight, until none is above: every target is the smaller of its stop
    and a common level times its weight. Each round raises the level from one row of sums.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = numbered(totals, [F.col("source").asc_nulls_last()], "sources", "place")
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.col("place") % len(weights) + 1).cast("int"),
    )
    sources = keep(
        ordered.select("source", "source_size", weight.alias("weight")).withColumn(
            "stop", F.col("source_size") * F.lit(float(most))
        ),
        "sources",
    )
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    level = 0.0
    while total:
        stopped = F.col("stop") <= F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("stop"))), F.lit(0.0)).alias("stops"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("weights"),
        ).first()
        if not sums["weights"]:
            break
        raised = (total - sums["stops"]) / sums["weights"]
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    target = F.least(F.col("stop"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: float = MOST,
    seed: int = 17,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, source, size, source_size, target, copies, taken``.

    ``size`` is the number of words, 0 for a null text; ``copies`` how often the mix takes the
    document, ``taken`` those copies' words. A null source is a source of its own, the last one; a
    source without words takes nothing. ``text_key`` is a hash of the text that tells rows with the
    same id apart; identical rows are drawn one by one. An empty table gives an empty result.
    """
    sizes = keep(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.xxhash64(F.col(text_column)).alias("text_key"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column)).alias("size"),
        ),
        "sizes",
    )
    targets = source_targets(sizes.select("source", "size"), weights, total_share, most)
    targets = targets.withColumnRenamed("source", "of")
    counted = sizes.groupBy(*sizes.columns).agg(F.count(F.lit(1)).alias("all_repeats"))
    blocks = counted.withColumn("block", F.explode(F.expr(f"sequence(0L, (all_repeats - 1) div {BLOCK_ROWS})")))
    repeats = F.least(F.lit(BLOCK_ROWS), F.col("all_repeats") - F.col("block") * BLOCK_ROWS).cast("int")
    rows = blocks.withColumn("repeats", repeats).join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = max(1, math.ceil(sizes.count() / BUCKET_ROWS))
    order = F.when(F.col("block") == 0, F.xxhash64(F.lit(seed), "doc_id", "text_key")).otherwise(
        F.xxhash64(F.lit(seed), "doc_id", "text_key", "block")
    )
    fraction = F.col("ratio") - F.floor("ratio")
    units = rows.withColumn("ratio", ratio).select(
        # A null among integers would turn them into floating point numbers in the groups.
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        *("text_key", "source", "size", "source_size", "target"),
        F.floor("ratio").cast("int").alias("base"),
        F.pmod(order, F.lit(buckets)).alias("bucket"),
        F.when(fraction > 1 - SNAP, 1.0)
        .when(fraction < SNAP, 0.0)
        .otherwise(fraction)
        .alias("p"),
        "repeats",
    )
    decided = F.col("p").isin(0.0, 1.0)
    flown = keep(units.groupBy("bucket").applyInPandas(_flight(seed, 0, False), UNITS), "flight")
    parts, open_units, level = [flown.filter(decided)], flown.filter(~decided), 0
    while True:
        level += 1
        last = (buckets - 1) >> (FAN_IN_BITS * level) == 0
        grouped = open_units.withColumn("bucket", F.expr(f"bucket >> {FAN_IN_BITS}"))
        flown = keep(
            grouped.groupBy("source", "bucket").applyInPandas(_flight(seed, level, last), UNITS),
            "flight",
        )
        parts.append(flown.filter(decided))
        open_units = flown.filter(~decided)
        if last:
            break
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    copies = (F.col("base") + F.col("p")).cast("int")
    return result.select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        *("text_key", "source", "size", "source_size", "target"),
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def _flight(seed: int, level: int, landing: bool):
    """The flight over one group's rows, each source on its own, in a fixed order."""

    def fly(rows: pd.DataFrame) -> pd.DataFrame:
        if "repeats" in rows:
            repeats = rows.pop("repeats").to_numpy()
            rows = rows.iloc[np.repeat(np.arange(len(rows)), repeats)]
        keys = ["doc_id", "no_id", "text_key", "size"]
        rows = rows.sort_values(keys, kind="stable", ignore_index=True)
        mixed = pd.util.hash_array(rows["doc_id"].to_numpy("int64") ^ np.int64(seed))
        rows = rows.iloc[np.argsort(mixed, kind="stable")].reset_index(drop=True)
        bucket = int(rows["bucket"].iloc[0]) if len(rows) else 0
        p = rows["p"].to_numpy(float).copy()
        size = rows["size"].to_numpy(float)
        for source, at in rows.groupby("source", dropna=False, sort=True).indices.items():
            words = [ord(c) for c in source] if isinstance(source, str) else [0x110000]
            rng = np.random.default_rng([seed, level, bucket, len(words), *words])
            undecided = [int(i) for i in at if 0.0 < p[i] < 1.0]
            held = held_back(size, undecided)
            move(p, size, [i for i in undecided if i not in held], rng)
            if landing:
                land(p, size, [i for i in undecided if 0.0 < p[i] < 1.0])
        return rows.assign(p=p)

    return fly


def move(p: np.ndarray, size: np.ndarray, undecided: list[int], rng: np.random.Generator) -> None:
    """Fly until at most two are undecided. Each step keeps the sums of p and of p * size."""
    waiting: list[int] = []
    for unit in undecided:
        waiting.append(unit)
        while len(waiting) == 3:
            a, b, c = waiting
            u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            ahead = min((1 - p[i]) / d if d > 0 else -p[i] / d for i, d in zip(waiting, u) if d)
            back = min(p[i] / d if d > 0 else (p[i] - 1) / d for i, d in zip(waiting, u) if d)
            step = ahead if rng.random() * (ahead + back) < back else -back
            for i, d in zip(waiting, u):
                p[i] += step * d
                if p[i] < SNAP:
                    p[i] = 0.0
                elif p[i] > 1 - SNAP:
                    p[i] = 1.0
            waiting = [i for i in waiting if 0.0 < p[i] < 1.0]


def held_back(size: np.ndarray, undecided: list[int]) -> set[int]:
    """Up to ``HELD`` units of evenly spread sizes, which wait for the landing."""
    by_size = sorted(undecided, key=lambda i: (size[i], i))
    at = np.linspace(0, len(by_size) - 1, min(HELD, len(by_size))).astype(int)
    return {by_size[k] for k in at}


def land(p: np.ndarray, size: np.ndarray, undecided: list[int]) -> None:
    """Decide the last dozen: of all their subsets, the one whose words come nearest to what is
    expected, among those whose number of documents is at most one off."""
    if not undecided:
        return
    n, at = len(undecided), np.array(undecided)
    subsets = np.arange(2**n)[:, None] >> np.arange(n) & 1
    words = np.abs(subsets @ size[at] - p[at] @ size[at])
    documents = np.abs(subsets.sum(axis=1) - p[at].sum())
    best = subsets[np.lexsort((documents, words, documents > 1))[0]]
    p[at] = best.astype(float)


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    text, source = options.get("text_column", "text"), options.get("source_column", "source")
    (mix_id, mix_key, mix_source, each, more_left, place) = (fresh(n) for n in ("id", "key", "source", "each", "more", "place"))
    drawn = keep(
        mix(docs, id_column, **options)
        .groupBy("doc_id", "text_key", "source")
        .agg(F.sum("copies").alias("all_copies"), F.count(F.lit(1)).alias("rows"))
        .select(
            F.col("doc_id").alias(mix_id),
            F.col("text_key").alias(mix_key),
            F.col("source").alias(mix_source),
            F.expr("cast(all_copies div rows as int)").alias(each),
            (F.col("all_copies") % F.col("rows")).alias(more_left),
        ),
        "drawn",
    )
    key: Column = F.xxhash64(F.col(text))
    same = (
        F.col(id_column).cast("long").eqNullSafe(F.col(mix_id))
        & (key == F.col(mix_key))
        & F.col(source).cast("string").eqNullSafe(F.col(mix_source))
    )
    # Rows that repeat an id, text and source share their copies evenly, and the first of them take
    # one more each until none is left.
    even = docs.join(drawn.filter((F.col(each) > 0) & (F.col(more_left) == 0)), same)
    result = _repeated(even, docs.columns, each)
    uneven = drawn.filter(F.col(more_left) > 0)
    if not uneven.isEmpty():
        number = fresh("number")
        placed = docs.withColumn(place, F.monotonically_increasing_id())
        more = (F.col(number) <= F.col(more_left)).cast("int")
        shared = _numbered_repeats(placed.join(uneven, same), [mix_id, mix_key, mix_source], place, number)
        shared = shared.withColumn(each, F.col(each) + more).filter(F.col(each) > 0)
        result = result.unionByName(_repeated(shared, docs.columns, each))
    return result


def _repeated(rows: DataFrame, columns: list[str], each: str) -> DataFrame:
    return rows.withColumn(fresh("copy"), F.explode(F.sequence(F.lit(1), F.col(each)))).select(*columns)


def _numbered_repeats(rows: DataFrame, group: list[str], place: str, number: str) -> DataFrame:
    """Number the rows of each group from 1. They are numbered inside each part of the input, and a
    part starts behind the rows of those before it, so that no task sees all of them."""
    part, start, inside = fresh("part"), fresh("start"), fresh("inside")
    # The upper bits of a place are the part it was read in.
    parts = keep(rows.withColumn(part, F.shiftright(F.col(place), 33)), "repeats")
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, part]
    of = {c: fresh("of") for c in keys}
    starts = keep(
        parts.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*(F.col(c).alias(of[c]) for c in keys), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start)),
        "starts",
    )
    in_part = F.row_number().over(Window.partitionBy(*keys).orderBy(place))
    at = F.lit(True)
    for column in keys:
        at = at & F.col(column).eqNullSafe(F.col(of[column]))
    return (
        parts.withColumn(inside, in_part).join(starts, at).withColumn(number, F.col(inside) + F.col(start))
    )
