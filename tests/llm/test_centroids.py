"""Centroid clustering against brute force in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from martwright.llm import centroids
from martwright.llm.centroids import Orchard, cluster
from martwright.llm.queries import QUERIES

from .conftest import SF_DIR, as_rows, table

COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
VECTORS = "vec_id long, embedding array<double>, cluster string, distance string"


def clusters_by_brute_force(rows, k=16, rounds=3, dimensions=64):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [r for r in kept if r[0] is not None]
    named.sort(key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in named[:k]]
    if not now:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(now))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(now)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                now[j] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [nearest(v) for _, v in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    inertia = [sum(d for d, c in found if c == j) for j in range(len(now))]
    return [(i, c, d, inertia[c], sum(inertia), names[c]) for (i, _), (d, c) in zip(kept, found)]


def test_the_query_against_brute_force(spark):
    rows = as_rows(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), "vec_id", "embedding")
    found = as_rows(QUERIES["op13_centroids"](spark, SF_DIR), *COLUMNS)
    assert sorted(found) == sorted(clusters_by_brute_force(rows))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4).round(1).tolist()) for i in range(60)]
    rows += [(i, [0.5, -0.25, 0.0, 1.0]) for i in range(100, 140)]  # one common vector
    rows += [(3, [9.0, 9.0, 9.0, 9.0])] * 3 + rows[:5] + [(None, [1.0, 1.0, 1.0, -1.0])] * 2
    rows += [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0] * 5), (204, [nan, 1.0, 1.0, 1.0]),
             (205, [inf, 0.0, 0.0, 0.0]), (206, [None, 1.0, 1.0, 1.0]), (207, [0.0, -0.0, 1e-300, -1e-300])]
    frame = table(spark, [(*r, "a", "b") for r in rows], VECTORS)
    for k in (1, 2, 7, 500):
        found = as_rows(cluster(frame.repartition(5), centroids=k, dimensions=4), *COLUMNS)
        assert sorted(found, key=str) == sorted(clusters_by_brute_force(rows, k, 3, 4), key=str)
    assert as_rows(cluster(frame.limit(0)), *COLUMNS) == []
    assert as_rows(cluster(frame.filter("vec_id in (200, 205)"), dimensions=4), *COLUMNS) == []
    assert as_rows(cluster(frame.filter("vec_id is null"), dimensions=4), *COLUMNS) == []
    large = table(spark, [(1, [1e300, 0.0]), (2, [2e6, -2e6]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(as_rows(cluster(large, dimensions=2, centroids=1, rounds=0), "vec_id", "inertia")) == [
        (i, 2 * (64 * 2_000_000) ** 2) for i in (2, 3)
    ]
    with pytest.raises(ValueError):
        cluster(large, dimensions=65)


@pytest.mark.parametrize("k", [1, 2, 3, 40, 300])
def test_the_search_finds_the_nearest_and_measures_few(k):
    rng = np.random.default_rng(k)
    # Few different values give many ties and repeated centroids.
    own = rng.integers(-3, 4, (k, 3)) if k < 300 else rng.integers(-4000, 4000, (k, 3))
    vectors = np.concatenate([rng.integers(-3, 4, (500, 3)), own[:20]])
    if k == 300:
        vectors = own[rng.integers(0, k, 500)] + rng.integers(-50, 50, (500, 3))
    found, distance, compared = Orchard(own).search(vectors)
    every = ((vectors[:, None, :] - own[None, :, :]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (found == every.argmin(axis=1)).all()
    assert (compared <= k).all()
    if k == 300:
        assert compared.mean() < 60


def test_largest_components_stay_exact():
    most = centroids.LARGEST
    own = np.array([[-most] * 64, [most] * 64, [most] * 63 + [most - 1]])
    vectors = np.array([[most] * 64, [-most] * 64, [0] * 64])
    found, distance, _ = Orchard(own).search(vectors)
    assert found.tolist() == [1, 0, 2] and distance.tolist() == [0, 0, 64 * most**2 - 2 * most + 1]
