"""Nearest neighbours by cosine, over stable projections in a kd-tree.

Vectors are scaled to length one, where the largest cosine is the smallest distance, and projected to
``DIMENSIONS`` Gaussian directions. The projected square distance of two vectors over their true one
follows a chi-square law, so a neighbour at distance d lies within d * sqrt(quantile) of the query's
projection with known probability. A search walks a kd-tree over projected points outward from the
query, verifies what it meets with the full vectors, and stops when the next projected distance fails
that test against the k-th best distance so far. Every neighbour is found with at least the
probability ``CONFIDENCE``.

The top of the tree is fitted on a bounded sample and splits the space into cells; every vector is
indexed in its cell, a crowded cell in several blocks. A query first searches its own cell, and then,
with the distance found there, the other cells that pass the same test.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

NEIGHBOURS = 5
DIMENSIONS = 8
CONFIDENCE = 0.98
# The bound of the sample that the cells are fitted on, and its smallest share per cell.
SAMPLE_ROWS = 20_000
SAMPLE_PER_CELL = 16
# Vectors per block and queries per search task, in expectation.
BLOCK_ROWS = 8192
QUERY_ROWS = 4096
LEAF_ROWS = 256
SLACK = 1e-9
SEED = 5

FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, dimensions: int) -> float:
    """For an even number of dimensions, by bisection of the closed form."""

    def above(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))

    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > 1 - p else (low, middle)
    return high


def directions(size: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, DIMENSIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that tiny and huge ones neither vanish nor overflow.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


class Cells:
    """The top of the tree: regions of projected space, bounded by the splits."""

    def __init__(self, sample: np.ndarray, weight: float, cells: int):
        """``sample``: projected vectors, each standing for ``weight`` rows."""
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.blocks: list[int] = []
        self.splits: list[tuple[int, float, int, int]] = []
        box = np.full(DIMENSIONS, -np.inf), np.full(DIMENSIONS, np.inf)
        self.root = self._grow(sample, weight, cells, *box)
        self.low_box, self.high_box = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray, weight: float, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        """Nodes are positive numbers of splits, cells are -1 - number."""
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(DIMENSIONS)
        axis = int(spread.argmax())
        if cells > 1 and len(rows) >= 2 * SAMPLE_PER_CELL and spread[axis] > 0:
            value = float(np.median(rows[:, axis]))
            left = rows[:, axis] < value
            if not left.any():
                value = float(rows[rows[:, axis] > value, axis].min())
                left = rows[:, axis] < value
            at = len(self.splits)
            self.splits.append((axis, value, 0, 0))
            upper, lower = high.copy(), low.copy()
            upper[axis], lower[axis] = value, value
            first = self._grow(rows[left], weight, (cells + 1) // 2, low, upper)
            second = self._grow(rows[~left], weight, cells // 2, lower, high)
            self.splits[at] = (axis, value, first, second)
            return at
        self.low.append(low)
        self.high.append(high)
        self.blocks.append(max(1, math.ceil(len(rows) * weight / BLOCK_ROWS)))
        return -len(self.low)

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each projected point."""
        result = np.empty(len(points), np.int32)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                result[at] = -1 - node
                continue
            axis, value, first, second = self.splits[node]
            left = points[at, axis] < value
            todo += [(first, at[left]), (second, at[~left])]
        return result

    def square_distances(self, point: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low_box - point, point - self.high_box), 0)
        return (gap * gap).sum(axis=1)


class Tree:
    """A kd-tree over one block: leaves of projected points with their bounding boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            at = todo.pop()
            if len(at) <= LEAF_ROWS:
                self.leaves.append(at)
                continue
            own = points[at]
            axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
            order = np.argpartition(own[:, axis], len(at) // 2)
            todo += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
        self.low = np.array([points[at].min(axis=0) for at in self.leaves])
        self.high = np.array([points[at].max(axis=0) for at in self.leaves])

    def square_distances(self, point: np.ndarray) -> np.ndarray:
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (gap * gap).sum(axis=1)


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest scores, ties to the smaller id; an id with several vectors counts once."""
    most = len(scores)
    if most > 2 * k:
        # Sorting can wait for those that reach the k-th best, unless repeated ids are among them.
        near = scores >= np.partition(scores, most - 2 * k)[most - 2 * k]
        if len(np.unique(ids[near])) >= k:
            ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)[:k]]
    return ids[order], scores[order]


def _search(k: int, factor: float):
    """Search one block for its queries."""

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if len(block) and len(queries):
            ids = block.column("vec_id").to_numpy()
            vectors = _matrix(block.column("vector"))
            lengths = np.sqrt((vectors * vectors).sum(axis=1))
            project = directions(vectors.shape[1])
            points = unit(vectors) @ project
            tree = Tree(points)
            wanted = _matrix(queries.column("query"))
            origins = unit(wanted) @ project
            names = queries.column("query_id").to_pylist()
            bounds = queries.column("bound").to_pylist()
            for name, bound, vector, origin in zip(names, bounds, wanted, origins):
                length = math.sqrt((vector * vector).sum())
                best_id, best_score = np.zeros(0, np.int64), np.zeros(0)
                # The square of the distance at which the test stops the walk.
                limit = math.inf if bound is None else factor * (2 - 2 * bound) + SLACK
                away = tree.square_distances(origin)
                order = np.argsort(away, kind="stable")
                # Outward, one leaf at first and then twice as many each time.
                done, step = 0, 1
                while done < len(order) and away[order[done]] <= limit:
                    leaves = order[done : done + step]
                    done, step = done + step, 2 * step
                    at = np.concatenate([tree.leaves[i] for i in leaves[away[leaves] <= limit]])
                    gap = points[at] - origin
                    at = at[((gap * gap).sum(axis=1) <= limit) & (ids[at] != name)]
                    if not len(at):
                        continue
                    score = (vectors[at] * vector).sum(axis=1) / (lengths[at] * length)
                    score = np.concatenate([best_score, score])
                    own = np.concatenate([best_id, ids[at]])
                    best_id, best_score = best_of(own, score, k)
                    if len(best_id) == k:
                        limit = min(limit, factor * (2 - 2 * best_score[-1]) + SLACK)
                out_query += [name] * len(best_id)
                out_id.append(best_id)
                out_score.append(best_score)
        return pa.table(
            {
                "query_id": pa.array(out_query, pa.int64()),
                "vec_id": pa.array(np.concatenate(out_id) if out_id else [], pa.int64()),
                "score": pa.array(np.concatenate(out_score) if out_score else [], pa.float64()),
            }
        )

    return search


def _usable(vector: Column) -> Column:
    """Without null or non-finite components, and not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its ``k`` best rows found, or all if
    there are fewer, by the cosine of the original vectors in double precision, ties to the smaller
    id. A query is not its own neighbour.

    Vectors that are null, zero or hold a null or non-finite component take no part, and neither do
    those of another size than most. Repeated rows count once; if an id has several vectors, the best
    of them counts. An empty table gives an empty result.
    """
    rows = keep(
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(vector_column).cast("array<double>").alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        )
        .filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
        .distinct(),
        "vectors",
    )
    spark = rows.sparkSession
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], f"query_id long, rank int, vec_id long, score double")
    size, count = common["size"], common["count"]
    rows = rows.filter(F.size("vector") == size)
    share = min(1.0, SAMPLE_ROWS / count)
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    project = directions(size)

    def points(source):
        for batch in source:
            if len(batch):
                found = unit(_matrix(batch.column("vector"))) @ project
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), DIMENSIONS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), lists.cast(pa.list_(pa.float64()))], ["vec_id", "point"]
                )

    # Only the projections of the sample come to the driver.
    found = rows.filter(draw).select("vec_id", "vector").mapInArrow(points, "vec_id long, point array<double>")
    sample = found.orderBy("vec_id", "point").toArrow().column("point")
    sample = _matrix(sample) if len(sample) else np.zeros((0, DIMENSIONS))
    cells = Cells(sample, 1 / share, math.ceil(count / BLOCK_ROWS))
    factor = chi_square_quantile(confidence, DIMENSIONS)

    def place(source):
        for batch in source:
            if len(batch):
                cell = cells.of(unit(_matrix(batch.column("vector"))) @ project)
                yield batch.append_column("cell", pa.array(cell))

    placed = keep(
        rows.mapInArrow(place, "vec_id long, vector array<double>, is_query boolean, cell int"), "placed"
    )
    block_of = F.element_at(F.array(*(F.lit(b) for b in cells.blocks)), F.col("cell") + 1)
    index = placed.select(
        "cell",
        F.pmod(F.xxhash64("vec_id"), block_of).cast("int").alias("block"),
        "vec_id",
        "vector",
    )
    queries = placed.filter("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.col("cell").alias("home")
    )
    own = queries.select(
        "query_id", "query", F.col("home").alias("cell"), F.lit(None).cast("double").alias("bound")
    )
    near = keep(_searched(index, own, cells, k, factor), "near")
    # The k-th best of a query's own cell; null where the cell has fewer.
    ranked = _best(near, k)
    reached = (
        ranked.filter(F.col("rank") == k)
        .select(F.col("query_id").alias("of"), F.col("score").alias("bound"))
    )
    bounded = queries.join(reached, F.col("query_id") == F.col("of"), "left").drop("of")

    def visits(source):
        for batch in source:
            if not len(batch):
                continue
            origins = unit(_matrix(batch.column("query"))) @ project
            homes, bounds = batch.column("home").to_pylist(), batch.column("bound").to_pylist()
            at, where = [], []
            for i, (origin, home, bound) in enumerate(zip(origins, homes, bounds)):
                limit = math.inf if bound is None else factor * (2 - 2 * bound) + SLACK
                wanted = np.flatnonzero(cells.square_distances(origin) <= limit)
                wanted = wanted[wanted != home]
                at += [i] * len(wanted)
                where.append(wanted)
            taken = batch.take(pa.array(at, pa.int64()))
            cell = pa.array(np.concatenate(where), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [taken.column("query_id"), taken.column("query"), cell, taken.column("bound")],
                ["query_id", "query", "cell", "bound"],
            )

    others = bounded.mapInArrow(visits, "query_id long, query array<double>, cell int, bound double")
    far = _searched(index, keep(others, "visits"), cells, k, factor)
    return _best(near.unionByName(far), k).select("query_id", "rank", "vec_id", "score")


def _searched(index: DataFrame, visits: DataFrame, cells: Cells, k: int, factor: float) -> DataFrame:
    """Search the cells named by ``visits``. A cell with many visits is searched by several tasks,
    each with a copy of a block and some of the queries."""
    counts = {row["cell"]: row["count"] for row in visits.groupBy("cell").count().collect()}
    parts = [max(1, math.ceil(counts.get(c, 0) / QUERY_ROWS)) for c in range(len(cells.blocks))]
    part_of = F.element_at(F.array(*(F.lit(p) for p in parts)), F.col("cell") + 1)
    block_of = F.element_at(F.array(*(F.lit(b) for b in cells.blocks)), F.col("cell") + 1)
    blocks = index.withColumn("part", F.explode(F.sequence(F.lit(0), part_of - 1)))
    asked = visits.withColumn("part", F.pmod(F.xxhash64("query_id"), part_of).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), block_of - 1))
    )
    keys = ("cell", "block", "part")
    return blocks.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search(k, factor), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query; a query has at most ``k`` rows per block it visited."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k)
