"""Centroid clustering with n-simplex projection.

Vectors become integers (``floor(64 * x)``). A few pivots are chosen among the first centroids, and every vector's exact
squared distances to them are stored with it once. Pivots span a simplex; the distances of a vector to them are the
edges of one more corner, its apex: coordinates in the pivots' span and, last, the altitude above it. For two
apexes the Euclidean distance is a lower bound of the distance of their vectors, and the one with the
altitudes added instead of subtracted an upper bound. A centroid whose lower bound exceeds the least upper
bound of a vector is out; the others are compared by exact integer distances (ties: the smaller number).

Each round reads the stored points once. A task folds its vectors to one sum a centroid before anything is
shuffled; what reaches the driver is ``k`` centroids a round.

Defined cases: vectors that are null, of another length, or with a null or non-finite component are left out; with fewer
than ``k`` vectors there are as many centroids as vectors; without any the result is empty. Rows are
clustered one by one, repeated ones alike. First centroids with equal hashes follow their components; a null
``vec_id`` comes last. A component beyond ``LARGEST`` after scaling raises, as its squared distance
may not fit a long. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.text import flat, scratch, stored

SIZE, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Pivots at most; one more is taken only while its altitude is this share of the widest distance between first centroids.
PIVOTS, ALTITUDE_SHARE = 16, 0.3
#: Bounds are widened by this share of the largest squared distance at hand. Solving by pivots of such altitudes multiplies
#: rounding errors by at most (1 + 1 / 0.3) ** 15, about 4e9, of 1.1e-16 each.
SLACK = 1e-6
LARGEST = 1 << 27
#: Vectors compared at a time inside a task.
ROWS = 16384


@dataclass
class Simplex:
    """Pivots, and their coordinates as corners of a simplex (the first at the origin, each with one more coordinate)."""

    pivots: np.ndarray
    corners: np.ndarray

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Apex of each row of squared distances to the pivots; the altitude is the last coordinate."""
        first = squared[:, 0].astype(float)
        if len(self.pivots) == 1:
            return np.sqrt(first)[:, None]
        base = self.corners[1:]
        right = (first[:, None] - squared[:, 1:] + (base**2).sum(1)) / 2
        inside = np.zeros_like(right)
        for j in range(len(base)):  # each pivot adds one coordinate
            inside[:, j] = (right[:, j] - (inside[:, :j] * base[j, :j]).sum(1)) / base[j, j]
        altitude = np.sqrt(np.maximum(first - (inside**2).sum(1), 0))
        return np.column_stack([inside, altitude])


def squared_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row for each point."""
    out = np.empty((len(points), len(others)), np.int64)
    for k, other in enumerate(others):
        gap = points - other
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def choose_simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Pivots among the candidates, each time the one of the greatest altitude over the simplex so far."""
    squared = squared_distances(candidates, candidates)
    widest = np.sqrt(float(squared.max()))
    chosen, corners = [0], np.zeros((1, 0))
    while len(chosen) < min(most, len(candidates)) and widest > 0:
        apexes = Simplex(candidates[chosen], corners).apexes(squared[:, chosen])
        k = int(apexes[:, -1].argmax())
        if apexes[k, -1] < ALTITUDE_SHARE * widest:
            break
        corners = np.vstack([np.column_stack([corners, np.zeros(len(corners))]), apexes[k]])
        chosen.append(k)
    return Simplex(candidates[chosen], corners)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between two sets of apexes."""
    span = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(2)
    return span + (a[:, None, -1] - b[None, :, -1]) ** 2, span + (a[:, None, -1] + b[None, :, -1]) ** 2


def nearest(points: np.ndarray, squared: np.ndarray, simplex: Simplex, centroids: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster of each point, its squared distance (0 where only one centroid was left, unless ``exact``), and the number of exact comparisons."""
    apex = simplex.apexes(squared)
    to_pivots = squared_distances(centroids, simplex.pivots)
    low, high = bounds(apex, simplex.apexes(to_pivots))
    slack = SLACK * (squared.max(1) + to_pivots.max() + 1.0)
    left = low <= (high.min(1) + slack)[:, None] + slack[:, None]
    single = left.sum(1) == 1
    cluster = left.argmax(1)
    least = np.full(len(points), np.iinfo(np.int64).max)
    done = 0
    for k in range(len(centroids)):
        rows = np.flatnonzero(left[:, k] if exact else left[:, k] & ~single)
        if len(rows) == 0:
            continue
        done += len(rows)
        gap = points[rows] - centroids[k]
        distance = np.einsum("ij,ij->i", gap, gap)
        closer = distance < least[rows]  # an equal one has the smaller number
        least[rows[closer]], cluster[rows[closer]] = distance[closer], k
    least[least == np.iinfo(np.int64).max] = 0
    return cluster, least, done


def kept_vectors(vectors: DataFrame, size: int = SIZE) -> DataFrame:
    """``vec_id`` and ``x`` (doubles) of the usable vectors."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    return rows.filter((F.size("x") == size) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    values = flat(column).flatten().to_numpy(zero_copy_only=False)
    return values.astype(kind).reshape(len(column), -1) if len(column) else np.empty((0, 0), kind)


def scaled(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    v = np.floor(scale * x)
    if len(v) and np.abs(v).max() > LARGEST:
        raise ValueError(f"A component times {scale} is beyond {LARGEST}: squared distances may not fit a long")
    return v.astype(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind))


def with_pivot_distances(kept: DataFrame, simplex: Simplex, scale: int) -> DataFrame:
    """``vec_id, v`` (integers) and ``d`` (exact squared distances to the pivots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            v = scaled(matrix(batch.column("x"), float), scale)
            d = squared_distances(v, simplex.pivots)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists(v, pa.int32()), lists(d, pa.int64())], ["vec_id", "v", "d"])

    return kept.mapInArrow(run, "vec_id long, v array<int>, d array<long>")


def cluster_sums(points: DataFrame, simplex: Simplex, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and component sums of each non-empty cluster; one row a cluster and task is shuffled."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), size), np.int64)
        for batch in batches_of(batches):
            v = matrix(batch.column("v"), np.int64)
            cluster, _, _ = nearest(v, matrix(batch.column("d"), np.int64), simplex, centroids, False)
            for k in np.unique(cluster):
                mine = v[cluster == k]
                count[k] += len(mine)
                total[k] += mine.sum(0)
        k = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(count[k], pa.int64()), lists(total[k], pa.int64())], ["cluster", "n", "total"])

    parts = points.mapInArrow(run, "cluster int, n long, total array<long>")
    sums = [F.sum(F.col("total")[j].cast("decimal(20,0)")).alias(f"s{j}") for j in range(size)]
    return {r.cluster: (r.n, [int(r[f"s{j}"]) for j in range(size)]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect()}


def assigned(points: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            cluster, distance, _ = nearest(matrix(batch.column("v"), np.int64), matrix(batch.column("d"), np.int64), simplex, centroids, True)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return points.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, size)
    drawn = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v))).limit(k).collect()
    centroids = scaled(np.array([r.x for r in first], float).reshape(len(first), size), scale)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    simplex = choose_simplex(centroids)
    root = scratch(spark)
    points = stored(with_pivot_distances(kept, simplex, scale), root, "points")
    for _ in range(rounds):
        for c, (n, total) in cluster_sums(points, simplex, centroids).items():
            centroids[c] = [t // n for t in total]
    found = stored(assigned(points, simplex, centroids), root, "assigned")
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame([(c, s, whole, digest[c]) for c, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
