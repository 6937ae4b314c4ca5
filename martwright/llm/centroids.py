"""Centroid clustering with Orchard's search.

Vectors become whole numbers, so that every distance, sum and centroid is exact and no order of
addition matters. For each centroid the others are listed by their distance to it. A vector starts at
some centroid and walks its list; whenever it finds a closer centroid it jumps to that one's list, and
what it has visited is not measured again. By the triangle inequality the walk can stop at the first
listed centroid strictly beyond twice the current distance: every one that could be as near has been
met by then, so ties are decided as over all centroids.

A round is one pass over the stored vectors. Tasks send one row of sums per centroid, whatever they
read; centroids and their lists, which do not grow with the data, go to the tasks with the code.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
# Scaled components up to here keep every squared distance of up to 64 of them in a long.
LARGEST = 1 << 27
# Vectors searched at once.
SLICE = 1 << 12

INTEGERS = "vec_id long, vector array<int>"
ASSIGNED = "vec_id long, cluster int, distance long, compared int"
SUMS = "cluster int, n long, sums array<long>"


class Orchard:
    """Centroids with, for each, the others in ascending distance."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        k = len(self.centroids)
        between = np.stack([self._distance(self.centroids, np.full(k, c)) for c in range(k)])
        # Stable, so equal distances are listed by number; each list begins with the centroid itself.
        between[np.arange(k), np.arange(k)] = -1
        self.order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.away = np.take_along_axis(between, self.order, axis=1)
        # A walk starts at the nearest of about sqrt(k) centroids.
        self.starts = np.arange(0, k, max(1, math.isqrt(k)))

    def _distance(self, vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        gap = vectors - self.centroids[centroid]
        return np.einsum("ij,ij->i", gap, gap)

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest centroid of each vector (ties: the smaller number), its squared distance, and how
        many centroids were measured."""
        n, k = len(vectors), len(self.centroids)
        cluster, nearest = np.zeros(n, np.int64), np.zeros(n, np.int64)
        visited = np.zeros((n, k), bool)
        visited[:, self.starts] = True
        for i, start in enumerate(self.starts):
            found = self._distance(vectors, np.full(n, start))
            closer = found < nearest if i else np.ones(n, bool)
            cluster[closer], nearest[closer] = start, found[closer]
        walking, place = np.arange(n) if k > 1 else np.zeros(0, np.int64), np.zeros(n, np.int64)
        while len(walking):
            at, listed = cluster[walking], place[walking]
            # Not strictly beyond twice the current distance; a quarter of the square, rounded up, says
            # so without leaving the longs.
            walking = walking[-(-self.away[at, listed] // 4) <= nearest[walking]]
            at, listed = cluster[walking], place[walking]
            other = self.order[at, listed]
            place[walking] += 1
            new = ~visited[walking, other]
            rows, other = walking[new], other[new]
            visited[rows, other] = True
            found = self._distance(vectors[rows], other)
            closer = (found < nearest[rows]) | ((found == nearest[rows]) & (other < cluster[rows]))
            rows = rows[closer]
            cluster[rows], nearest[rows], place[rows] = other[closer], found[closer], 0
            walking = walking[place[walking] < k - 1]
        return cluster, nearest, visited.sum(axis=1)


def _integers(dimensions: int, scale: int):
    """Vectors of the right size as whole numbers; others are left out."""

    def convert(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            lists = batch.column("vector")
            right = pc.fill_null(pc.equal(pc.list_value_length(lists), dimensions), False)
            ids, lists = batch.column("vec_id").filter(right), lists.filter(right)
            # A null component becomes NaN here.
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values.reshape(len(lists), dimensions) * scale)
            usable = (np.abs(values) <= LARGEST).all(axis=1)
            values = values[usable].astype(np.int32)
            at = pa.array(np.arange(len(values) + 1, dtype=np.int32) * dimensions)
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(usable)), pa.ListArray.from_arrays(at, pa.array(values.reshape(-1)))],
                ["vec_id", "vector"],
            )

    return convert


def _matrices(source: Iterator[pa.RecordBatch], dimensions: int):
    for batch in source:
        for k in range(0, len(batch), SLICE):
            part = batch.slice(k, SLICE)
            values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            yield part.column("vec_id"), values.astype(np.int64).reshape(len(part), dimensions)


def _sums(orchard: Orchard, dimensions: int):
    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(orchard.centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, vectors in _matrices(source, dimensions):
            cluster, _, _ = orchard.search(vectors)
            counts += np.bincount(cluster, minlength=k)
            if len(cluster):
                order = np.argsort(cluster, kind="stable")
                found, begins = np.unique(cluster[order], return_index=True)
                sums[found] += np.add.reduceat(vectors[order], begins, axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used.astype(np.int32)),
                pa.array(counts[used]),
                pa.array(sums[used].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    return add


def _assign(orchard: Orchard, dimensions: int):
    def assign(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in _matrices(source, dimensions):
            cluster, distance, compared = orchard.search(vectors)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(compared.astype(np.int32))],
                ["vec_id", "cluster", "distance", "compared"],
            )

    return assign


def _moved(vectors: DataFrame, centroids: np.ndarray, dimensions: int) -> np.ndarray:
    """The centroids after one round. Sums of any number of tasks add up as decimals."""
    parts = vectors.mapInArrow(_sums(Orchard(centroids), dimensions), SUMS)
    total = F.sum(F.col("value").cast("decimal(38,0)"))
    rows = (
        parts.select("cluster", "n", F.posexplode("sums").alias("place", "value"))
        .groupBy("cluster", "place")
        .agg(total.alias("total"), F.sum("n").alias("n"))
        .collect()
    )
    moved = centroids.copy()
    for row in rows:
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return moved


def seeded_order(vec_id: Column, seed: int) -> Column:
    """Where a vector stands among those that centroids start from."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = 1,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared`` per vector.

    Vectors with exactly ``dimensions`` components, none null or not finite, are kept, each component x
    as floor(``scale`` * x). Components beyond 2^27 then would not fit squared distances in a long; such
    vectors are left out too. The first ``centroids`` kept vectors by the hash of seed and id start as
    centroids 0, 1, ... (ties: the smaller vector); rows without an id start none. Rows that
    repeat are rows of their own. Each round replaces a centroid that has vectors by the floor of
    their mean. With fewer kept vectors there are as many centroids; with none, or none that
    has an id, the result is empty.

    ``distance`` is squared, ``cluster_inertia`` and ``inertia`` are its sums over the cluster and over
    all (null beyond a long); ``compared`` is the number of centroids measured in the last round.
    """
    if dimensions > 64:
        raise ValueError("squared distances of more than 64 components may not fit a long")
    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    kept = keep(chosen.mapInArrow(_integers(dimensions, scale), INTEGERS), "integers")
    # A bounded number of rows starts the centroids.
    first = (
        kept.filter(F.col("vec_id").isNotNull())
        .orderBy(seeded_order(F.col("vec_id"), seed), "vector")
        .limit(centroids)
        .collect()
    )
    if not first:
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long"
        return kept.sparkSession.createDataFrame([], f"{empty}, centroid_sha256 string, compared int")
    now = np.array([row["vector"] for row in first], np.int64)
    for _ in range(rounds):
        now = _moved(kept, now, dimensions)
    assigned = keep(kept.mapInArrow(_assign(Orchard(now), dimensions), ASSIGNED), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row per centroid; its sum over all of them is as small.
    sums = {row["cluster"]: row["total"] for row in assigned.groupBy("cluster").agg(total.alias("total")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]

    def long_or_null(value) -> int | None:
        return int(value) if value < 1 << 63 else None

    facts = kept.sparkSession.createDataFrame(
        [(c, long_or_null(n), long_or_null(sum(sums.values())), names[c]) for c, n in sums.items()],
        "of int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("of")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"
    )
