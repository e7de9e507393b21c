"""Exact clustering of integer vectors around centroids, with most distances ruled out by a few rotated coordinates.

A vector is stored as its integers, its leading coordinates along the principal axes of all vectors, and the norm of what
those leave. For a vector x and a centroid c, rotated about the mean,

    |x - c|^2 >= |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2

since the leading part is part of the distance, and the norms of the two rests differ by no more than the rests do. A centroid
whose bound exceeds the exact distance to the most promising one cannot be nearest; the others are compared in integers. The
rotation only decides how many are left, never the result, so it may be computed in floating point.

The driver holds the centroids and the axes, whose sizes are parameters; vectors stay where they are, and a round moves one
partial sum for each centroid and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.frames import Workspace

DIMENSION, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, "2"
LEAD = 8
# Components beyond this, embeddings beyond half a million, count as this; distances then fit a long.
MOST = 1 << 27
# What rounding can do to a bound, as a share of the squared norms it is made of.
SLACK = 1e-9
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Axes:
    mean: np.ndarray
    rotation: np.ndarray  # columns are axes, the one of the largest variance first

    def rotated(self, points: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
        turned = (points - self.mean) @ self.rotation
        return np.ascontiguousarray(turned[:, :lead]), np.sqrt((turned[:, lead:] ** 2).sum(axis=1))


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray  # int64, one row each
    lead: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(points: list[list[int]], axes: Axes, lead: int) -> Centroids:
        whole = np.array(points, np.int64)
        return Centroids(whole, *axes.rotated(whole.astype(np.float64), lead))

    def nearest(self, points: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid (of equally near ones the smallest), its squared distance, and how many
        centroids were compared in integers, for each row."""
        own, theirs = (lead**2).sum(axis=1), (self.lead**2).sum(axis=1)
        bound = own[:, None] + theirs - 2 * (lead @ self.lead.T) + (rest[:, None] - self.rest) ** 2
        bound -= SLACK * ((own + rest**2)[:, None] + theirs + self.rest**2) + 1e-3
        limit = _distances(points, self.points[bound.argmin(axis=1)])
        left = bound <= limit[:, None]
        number, best = np.zeros(len(points), np.int32), np.full(len(points), _LONG)
        for at, centroid in enumerate(self.points):
            rows = np.flatnonzero(left[:, at])
            found = _distances(points[rows], centroid)
            nearer = found < best[rows]
            number[rows[nearer]], best[rows[nearer]] = at, found[nearer]
        return number, best, left.sum(axis=1)


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    gap = points - others
    return np.einsum("ij,ij->i", gap, gap)


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """Rows whose embedding has exactly DIMENSION components, none of them null or not finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.filter((F.size("embedding") == DIMENSION) & finite)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _integers(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return np.clip(np.floor(values.reshape(-1, DIMENSION) * SCALE), -MOST, MOST).astype(np.int64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and products of the components of one task's rows, one row for each slot."""
    total = np.zeros((DIMENSION + 1, DIMENSION + 1))
    for batch in batches:
        points = _integers(batch).astype(np.float64)
        points = np.column_stack([points, np.ones(len(points))])
        total += points.T @ points
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["slot", "value"])


def principal_axes(kept: DataFrame) -> Axes:
    """From the moments of all vectors; the driver gets one number for each pair of components."""
    sums = np.zeros((DIMENSION + 1) ** 2)
    for row in kept.mapInArrow(_moments, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        sums[row.slot] = row.value
    products = sums.reshape(DIMENSION + 1, DIMENSION + 1)
    count = max(products[-1, -1], 1.0)
    mean = products[-1, :-1] / count
    _, axes = np.linalg.eigh(products[:-1, :-1] / count - np.outer(mean, mean))
    return Axes(mean, axes[:, ::-1])


def stored_points(kept: DataFrame, axes: Axes, lead: int = LEAD) -> DataFrame:
    """vec_id, point (the integers), lead, rest."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _integers(batch)
            leading, rest = axes.rotated(points.astype(np.float64), lead)
            packed = [pa.array([row.tobytes() for row in rows], pa.binary()) for rows in (points.astype("<i4"), leading.astype("<f8"))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *packed, pa.array(rest)], ["vec_id", "point", "lead", "rest"])

    return kept.mapInArrow(store, "vec_id long, point binary, lead binary, rest double")


def _unpacked(batch: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    rows = batch.column(name).to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _assigned(batch: pa.RecordBatch, centroids: Centroids) -> tuple[np.ndarray, ...]:
    points = _unpacked(batch, "point", "<i4").astype(np.int64)
    return points, *centroids.nearest(points, _unpacked(batch, "lead", "<f8"), batch.column("rest").to_numpy())


def _sums(stored: DataFrame, centroids: Centroids) -> dict[int, list[int]]:
    """Count and component sums of the vectors nearest to each centroid, exactly."""
    names = [f"s{i}" for i in range(DIMENSION)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, number, _, _ = _assigned(batch, centroids)
            found, at = np.unique(number, return_inverse=True)
            sums = np.zeros((len(found), DIMENSION), np.int64)
            np.add.at(sums, at, points)
            columns = [pa.array(found), pa.array(np.bincount(at)), *[pa.array(column) for column in sums.T]]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *names])

    partial = stored.mapInArrow(add, "cluster int, n long, " + ", ".join(f"{n} long" for n in names))
    exact = [F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in ["n", *names]]
    return {row[0]: [int(value) for value in row[1:]] for row in partial.groupBy("cluster").agg(*exact).collect()}


def first_points(stored: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> list[list[int]]:
    """The vectors with the smallest hash of `seed:vec_id` (null as empty), those of equal ids by their integers' bytes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = stored.select("point", order.alias("order")).orderBy("order", "point").limit(clusters).collect()
    return [np.frombuffer(row.point, "<i4").tolist() for row in rows]


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, lead: int = LEAD, seed: str = SEED) -> DataFrame:
    """`vectors(vec_id, embedding, ...)` -> one row for each kept vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256, n_verified (centroids compared in integers).

    Vectors that are null, of another length, or hold a null or a value that is not finite are left out; repeated rows and ids
    count each. Distances are squared, of integers floor(256 x); ties go to the smaller number, a centroid that loses all its
    vectors stays. Of fewer than `clusters` vectors each starts a cluster. A sum of distances beyond a long is given as the
    largest long. Extra columns are ignored, whatever their names; no vectors give no rows.
    """
    work = Workspace(vectors.sparkSession, "centroids")
    kept = kept_vectors(vectors)
    axes = principal_axes(kept)
    stored = work.table(stored_points(kept, axes, lead), "points")
    points = first_points(stored, clusters, seed)
    for _ in range(rounds if points else 0):
        for number, (n, *sums) in _sums(stored, Centroids.of(points, axes, lead)).items():
            points[number] = [s // n for s in sums]
    centroids = Centroids.of(points, axes, lead) if points else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, distance, verified = _assigned(batch, centroids)
            columns = [batch.column("vec_id"), pa.array(number), pa.array(distance), pa.array(verified.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "n_verified"])

    assigned = work.table(stored.mapInArrow(assign, "vec_id long, cluster int, distance long, n_verified int"), "assigned")
    inertia = {row.cluster: int(row.total) for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}
    whole = min(sum(inertia.values()), _LONG)
    of_cluster = [
        (number, min(total, _LONG), whole, hashlib.sha256(",".join(map(str, points[number])).encode()).hexdigest())
        for number, total in inertia.items()
    ]
    # At most `clusters` rows.
    totals = vectors.sparkSession.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_verified"]
    return assigned.join(F.broadcast(totals), "cluster").select(*columns)
