"""Approximate nearest neighbours over low-dimensional stable projections.

Vectors are projected to ``PROJECTED`` dimensions by Gaussian (2-stable) directions:
for a true distance d, the squared projected distance is d**2 times a chi-square
variable.  A kd-tree over the projections yields neighbours in order of projected
distance; each is verified by its true distance, until the chi-square test says that
a vector nearer than the current k-th would have been met with high probability.

The tree's upper levels, fitted on a bounded sample, deal all vectors into blocks.
A query first searches its own block, then only the blocks that the test leaves
open.  Every vector is indexed; a leaf that holds too many is cut into several blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import stored

PROJECTED = 8
#: Probability that a nearer vector would have been met when the search stops.
CONFIDENCE = 0.99
#: Vectors in a block, and in a leaf of a block's tree.
BLOCK_ROWS = 8192
LEAF_ROWS = 64
#: Vectors on which the upper levels of the tree are fitted, and most of those levels.
SAMPLE_ROWS = 50_000
MOST_LEVELS = 12


def chi_square_cdf(x: float, degrees: int = PROJECTED) -> float:
    """Closed form for an even number of degrees of freedom."""
    if x <= 0:
        return 0.0
    half, term, total = x / 2, 1.0, 1.0
    if half > 700:
        return 1.0
    for i in range(1, degrees // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi_square_quantile(p: float, degrees: int = PROJECTED) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


def directions(size: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, PROJECTED))


class UpperTree:
    """Complete binary tree of cuts of the projected space."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.axis = np.zeros((1 << levels) - 1, np.int64)
        self.cut = np.full((1 << levels) - 1, np.inf)
        self.low = np.full((1 << levels, PROJECTED), -np.inf)
        self.high = np.full((1 << levels, PROJECTED), np.inf)
        self._split(0, points, np.full(PROJECTED, -np.inf), np.full(PROJECTED, np.inf))

    def _split(self, node: int, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        inner = len(self.axis)
        if node >= inner:
            self.low[node - inner], self.high[node - inner] = low, high
            return
        if len(points):
            axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            self.axis[node], self.cut[node] = axis, np.median(points[:, axis])
        axis, cut = self.axis[node], self.cut[node]
        right = points[:, axis] > cut
        left_high, right_low = high.copy(), low.copy()
        left_high[axis], right_low[axis] = min(high[axis], cut), max(low[axis], cut)
        self._split(2 * node + 1, points[~right], low, left_high)
        self._split(2 * node + 2, points[right], right_low, high)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.levels):
            right = points[np.arange(len(points)), self.axis[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - len(self.axis)

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance from a point to every leaf's region."""
        off = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return (off * off).sum(axis=1)


class Block:
    """kd-tree over the projections of one block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: np.ndarray):
        self.ids, self.vectors, self.projection = ids, vectors, projection
        self.points = vectors @ projection
        leaves: list[np.ndarray] = []
        open_ = [np.arange(len(ids))]
        while open_:
            rows = open_.pop()
            if len(rows) <= LEAF_ROWS:
                leaves.append(rows)
                continue
            own = self.points[rows]
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            middle = len(rows) // 2
            order = np.argpartition(own[:, axis], middle)
            open_ += [rows[order[:middle]], rows[order[middle:]]]
        self.leaves = leaves
        self.low = np.array([self.points[r].min(axis=0) for r in leaves])
        self.high = np.array([self.points[r].max(axis=0) for r in leaves])

    def search(self, query: np.ndarray, own_id: int, k: int, bound: float, stop: float) -> list[tuple[float, int]]:
        """The ``k`` nearest found, as (distance, id); none is farther than ``bound``.

        ``stop``: the chi-square quantile.  Leaves are opened in order of distance;
        points are verified once no unopened leaf can hold one that is projected nearer.
        """
        point = query @ self.projection
        off = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        reach = (off * off).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        best: list[tuple[float, int]] = []
        waiting, away = np.zeros(0, np.int64), np.zeros(0)
        at = 0
        while at < len(order) or len(waiting):
            worst = best[k - 1][0] if len(best) >= k else bound
            nearest = away.min() if len(away) else math.inf
            frontier = min(nearest, reach[order[at]] if at < len(order) else math.inf)
            # Nothing unverified is projected nearer than the frontier: stop if a vector
            # nearer than the k-th would have been met by now.
            if frontier > stop * worst * worst:
                break
            opened = []
            while at < len(order) and (reach[order[at]] <= nearest or len(opened) < 4):
                opened.append(self.leaves[order[at]])
                at += 1
                if len(opened) >= 8:
                    break
            if opened:
                rows = np.concatenate(opened)
                gap = self.points[rows] - point
                waiting = np.concatenate([waiting, rows])
                away = np.concatenate([away, (gap * gap).sum(axis=1)])
            edge = reach[order[at]] if at < len(order) else math.inf
            ready = away <= edge
            if not ready.any():
                continue
            rows, waiting, away = waiting[ready], waiting[~ready], away[~ready]
            rows = rows[self.ids[rows] != own_id]
            distance = exact_distances(self.vectors[rows], query)
            near = distance <= worst
            best += zip(distance[near].tolist(), self.ids[rows[near]].tolist())
            best.sort()
            del best[k:]
        return best


def exact_distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    gap = vectors - query
    return np.sqrt((gap * gap).sum(axis=1))


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and without null or non-finite components."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _search(rows: DataFrame, size: int, k: int, stop: float, seed: int) -> DataFrame:
    """Search each block with the queries sent to it.

    ``rows``: block, kind (0 vector, 1 query), vec_id, embedding, bound.
    """
    dealt = rows.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "kind", "vec_id")

    def read(batches):
        projection = directions(size, seed)
        at, block, ids, vectors = None, None, [], []
        for batch in batches:
            found = []
            if batch.num_rows:
                where = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
                matrix = _matrix(batch.column(4), size)
                numbers, bounds = batch.column(3).to_numpy(), batch.column(5).to_numpy()
                cuts = np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1
                for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                    leaf, part, kind = where[:, start]
                    if (leaf, part) != at:
                        at, block, ids, vectors = (leaf, part), None, [], []
                    if kind == 0:
                        ids.append(numbers[start:end])
                        vectors.append(matrix[start:end])
                        continue
                    if not ids:
                        continue
                    if block is None:
                        block = Block(np.concatenate(ids), np.concatenate(vectors), projection)
                    for i in range(start, end):
                        near = block.search(matrix[i], int(numbers[i]), k, float(bounds[i]), stop)
                        found += [(int(numbers[i]), other, score) for score, other in near]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.float64()),
                ],
                ["query_id", "vec_id", "score"],
            )

    wanted = dealt.select("leaf", "part", "kind", "vec_id", "embedding", "bound")
    return wanted.mapInArrow(read, "query_id long, vec_id long, score double")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    confidence: float = CONFIDENCE,
    seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest vectors found.

    ``queries`` are rows like those of ``vectors``; vectors with the query's own id are
    no candidates.  Score: Euclidean distance in double precision; ties to the smaller
    id.  Vectors that are null, empty, zero, or hold null or non-finite components take
    no part, nor do rows without an id or vectors of another length than most.  A
    query id that repeats is one query, with the smallest of its vectors.  Without
    vectors the result is empty.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        kept = df.filter(usable(F.col(embedding)) & F.col(vec_id).isNotNull())
        return kept.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))

    lengths = clean(vectors).groupBy(F.size("embedding").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, total = usual["size"], usual["count"]
    rows = clean(vectors).filter(F.size("embedding") == size)
    asked = clean(queries).filter(F.size("embedding") == size).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    projection = directions(size, seed)
    part = min(1 << 20, math.ceil((1 << 20) * SAMPLE_ROWS / total))
    sample = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 20)) < part)

    def project(batches):
        for batch in batches:
            points = _matrix(batch.column(0), size) @ projection
            yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.float64()))], ["point"])

    # About SAMPLE_ROWS points of PROJECTED numbers.
    points = sample.select("embedding").mapInArrow(project, "point array<double>").limit(2 * SAMPLE_ROWS).collect()
    levels = min(MOST_LEVELS, max(0, math.ceil(math.log2(max(1, total / BLOCK_ROWS)))))
    tree = UpperTree(np.array([p["point"] for p in points]).reshape(-1, PROJECTED), levels)
    shared = spark.sparkContext.broadcast(tree)  # 2 ** MOST_LEVELS leaves at most

    @F.arrow_udf("int")
    def leaf(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.leaf_of(_matrix(column, size) @ projection), pa.int32())

    placed = stored(rows.withColumn("leaf", leaf("embedding")), "vectors")
    counts = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    counts = F.broadcast(counts)  # one row per leaf
    blocks = placed.join(counts, "leaf").select(
        "leaf",
        F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
        F.lit(0).alias("kind"),
        "vec_id",
        "embedding",
        F.lit(0.0).alias("bound"),
    )

    def sent(df: DataFrame) -> DataFrame:
        """Queries to all parts of their leaf."""
        every = df.join(counts, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return every.select("leaf", "part", F.lit(1).alias("kind"), "vec_id", "embedding", "bound")

    stop = chi_square_quantile(confidence)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    home = stored(asked.withColumn("leaf", leaf("embedding")), "queries")
    first = sent(home.withColumn("bound", F.lit(float("inf"))))
    first = stored(_search(blocks.union(first), size, k, stop, seed), "first-search")
    ranked = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    bounds = ranked.groupBy("query_id").agg(F.max("score").alias("far"), F.count("*").alias("n"))

    @F.arrow_udf("array<int>")
    def open_leaves(column: pa.Array, own: pa.Array, bound: pa.Array) -> pa.Array:
        made = shared.value
        out = []
        for point, at, far in zip(_matrix(column, size) @ projection, own.to_pylist(), bound.to_pylist()):
            open_ = np.flatnonzero(made.distances(point) <= stop * far * far if far < math.inf else made.low[:, 0] == made.low[:, 0])
            out.append(open_[open_ != at])
        return pa.array(out, pa.list_(pa.int32()))

    bounded = home.join(bounds, home["vec_id"] == bounds["query_id"], "left").select(
        "vec_id", "embedding", "leaf", F.when(F.col("n") >= k, F.col("far")).otherwise(float("inf")).alias("bound")
    )
    further = bounded.select("vec_id", "embedding", "bound", F.explode(open_leaves("embedding", "leaf", "bound")).alias("leaf"))
    second = _search(blocks.union(sent(further)), size, k, stop, seed)
    return (
        ranked.select("query_id", "vec_id", "score")
        .union(second)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
