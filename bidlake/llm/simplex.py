"""Centroid clustering with n-simplex projection.

The squared distances of a vector to a few pivots are computed once and solved
into apex coordinates: the place of the vector over the simplex of the pivots,
with its height above it.  Two apexes bound the distance of their vectors from
both sides (heights subtracted or added).  In each round the bounds rule out
centroids; only the others are compared exactly, in integers.  Sums per
cluster are added up in the tasks first, so a few thousand numbers reach the
driver in a round, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlake.llm.common import stored

LIMIT = 1 << 24  # scaled components are held within this, so that distances fit 64 bits


@dataclass(frozen=True)
class ClusterSettings:
    """Components a vector has, scale, number of centroids, rounds, prefix of the seeds' hash, most pivots."""
    dims: int = 64
    scale: int = 256
    centroids: int = 40
    rounds: int = 5
    seed: int = 2
    pivots: int = 16


def kept_vectors(embeddings: DataFrame, settings: ClusterSettings) -> DataFrame:
    """vec_id and v (scaled, rounded down) of the vectors with ``dims`` finite components."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    scaled = F.transform(x, lambda e: F.floor(F.least(F.greatest(F.lit(float(settings.scale)) * e.cast("double"), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    usable = x.isNotNull() & (F.size(x) == settings.dims) & ~F.coalesce(bad, F.lit(True))
    return embeddings.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of equal length as the rows of an integer matrix."""
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each point."""
    out = np.empty((len(rows), len(points)), dtype=np.int64)
    for k, point in enumerate(points):
        apart = rows - point
        out[:, k] = np.einsum("ij,ij->i", apart, apart)
    return out


class Simplex:
    """The pivots' simplex: its corners as a triangular matrix, solved for apex coordinates."""

    def __init__(self, pivots: np.ndarray, corners: np.ndarray):
        self.pivots, self.corners = pivots, corners

    @classmethod
    def spanning(cls, choices: np.ndarray, most: int) -> "Simplex":
        """Each next pivot is the choice that lies highest over the simplex so far; flat ones are left out."""
        base = choices.astype(np.float64) - choices[0]
        height = np.einsum("ij,ij->i", base, base)
        floor = 1e-4 * height.max(initial=0)
        chosen, axes = [0], []
        while len(chosen) < most and height.max(initial=0) > max(floor, 0.5):
            best = int(height.argmax())
            axis = base[best] - sum((base[best] @ a) * a for a in axes)
            axes.append(axis / np.linalg.norm(axis))
            chosen.append(best)
            height = np.maximum(height - (base @ axes[-1]) ** 2, 0)
            height[chosen] = 0
        corners = base[chosen[1:]] @ np.array(axes).T if axes else np.zeros((0, 0))
        return cls(choices[chosen], np.tril(corners))

    def apexes(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates over the base and the height, one row each, from the squared distances to the pivots."""
        distance = squared(rows, self.pivots).astype(np.float64)
        n = len(self.corners)
        place = np.zeros((len(rows), n + 1))
        for i in range(n):  # forward substitution
            right = (distance[:, 0] - distance[:, i + 1] + self.corners[i] @ self.corners[i]) / 2
            place[:, i] = (right - place[:, :i] @ self.corners[i, :i]) / self.corners[i, i]
        place[:, n] = np.sqrt(np.maximum(distance[:, 0] - (place[:, :n] ** 2).sum(axis=1), 0))
        return place


def possible(apexes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres may be nearest to each row: lower bound within the least upper bound, with room for rounding."""
    base, height = apexes[:, :-1], apexes[:, -1:]
    norms, sizes = (base ** 2).sum(axis=1, keepdims=True), (centres[:, :-1] ** 2).sum(axis=1)
    flat = np.maximum(norms + sizes - 2 * base @ centres[:, :-1].T, 0)
    lower, upper = flat + (height - centres[:, -1]) ** 2, flat + (height + centres[:, -1]) ** 2
    slack = 1e-6 * (norms + height ** 2 + sizes.max() + (centres[:, -1] ** 2).max() + 1)
    return lower <= upper.min(axis=1, keepdims=True) + slack


def nearest(rows: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance; only possible ones are compared."""
    may = possible(apexes, centres)
    row, centre = np.nonzero(may)
    apart = rows[row] - centroids[centre]
    distance = np.full(may.shape, np.iinfo(np.int64).max)
    distance[row, centre] = np.einsum("ij,ij->i", apart, apart)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(rows)), cluster]


SLICE = 1024  # rows that are compared at once


def projected(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """The vectors with their apex coordinates."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            apexes = simplex.apexes(matrix(batch.column("v")))
            ends = pa.array(np.arange(0, apexes.size + 1, apexes.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.ListArray.from_arrays(ends, pa.array(apexes.ravel()))], names=["vec_id", "v", "apex"])

    return vectors.select("vec_id", "v").mapInArrow(project, "vec_id long, v array<int>, apex array<double>")


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, centres: np.ndarray):
    """Slices of the batches with cluster and distance of each row."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        rows = matrix(batch.column("v"))
        apexes = batch.column("apex").flatten().to_numpy().reshape(len(rows), -1)
        yield batch, rows, *nearest(rows, apexes, centroids, centres)


def moved(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: floor of each cluster's mean; those of empty clusters stay."""
    centres = simplex.apexes(centroids)
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _batch, rows, cluster, _distance in _assigned(batches, centroids, centres):
            np.add.at(total, cluster, rows)
            count += np.bincount(cluster, minlength=k)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(full, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(full))), pa.array(total[full].ravel()),
             pa.array(np.repeat(count[full], dims))], names=["cluster", "dim", "total", "n"])

    sums = table.select("v", "apex").mapInArrow(add, "cluster int, dim int, total long, n long").groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    fresh = centroids.copy()
    for row in sums.collect():  # at most centroids x components rows
        fresh[row["cluster"], row["dim"]] = row["total"] // row["n"]
    return fresh


def clusters(embeddings: DataFrame, settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Vectors that are null, of another length than ``dims`` or hold a null or
    non-finite component are left out.  Scaled components beyond 2^24 count
    as 2^24 (below: -2^24).  Centroids start at the vectors with the smallest
    sha256 of ``seed:vec_id`` (equal ids: in the order of their components);
    a null vec_id never starts one, but is assigned and counted.  Fewer
    vectors than centroids give fewer centroids.  Repeated rows count as often
    as they stand.  Without a vector that can start a centroid the result is
    empty; other columns are not read.  Inertias beyond a long are its largest.
    """
    spark = embeddings.sparkSession
    vectors = stored(kept_vectors(embeddings, settings))
    order = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    seeds = vectors.where("vec_id is not null").select("v", order.alias("order")).orderBy("order", "v").limit(settings.centroids).collect()
    if not seeds:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([row["v"] for row in seeds], dtype=np.int64)
    simplex = Simplex.spanning(centroids, settings.pivots)
    table = stored(projected(vectors, simplex))
    for _round in range(settings.rounds):
        centroids = moved(table, centroids, simplex)
    centres = simplex.apexes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _rows, cluster, distance in _assigned(batches, centroids, centres):
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    found = stored(table.mapInArrow(assign, "vec_id long, cluster int, distance long"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # a row a centroid
    most = (1 << 63) - 1
    inertia = min(most, sum(int(row["total"]) for row in sums))
    named = [(row["cluster"], min(most, int(row["total"])), hashlib.sha256(",".join(map(str, centroids[row["cluster"]].tolist())).encode()).hexdigest()) for row in sums]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256")
