"""Clustering of vectors around integer centroids, nearest ones found by a tournament of bisectors.

Between two centroids lies the hyperplane of the points equally far from both.
Its normal and threshold are integers, worked out beforehand for every pair, so
one dot product and its sign tell which of two centroids is nearer, exactly. A
vector starts with centroid 0 and meets the others in turn; the nearer one goes
on, and on the hyperplane the smaller number does. After k - 1 tests the one
left is the nearest, and only its distance is computed.

Rounds read one written table of integer vectors. Each task sums up its
clusters before anything is shuffled; the driver sees k centroids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import written

#: Vectors that meet the centroids together; their numbers stay in a core's cache.
_BLOCK = 1024


def largest_component(dimensions: int) -> int:
    """Up to this size of components, squared distances fit into a long."""
    return math.isqrt((2**63 - 1) // (4 * dimensions))


class Bisectors:
    """Normals and thresholds of all pairs of centroids: k * (k - 1) / 2 rows of as many integers as a vector has."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        squares = np.sum(self.centroids**2, axis=1)
        #: At j, for each i < j, the normal that points from i to j, and its dot product with the points in between.
        self.normals = [2 * (c - self.centroids[:j]) for j, c in enumerate(self.centroids)]
        self.thresholds = [s - squares[:j] for j, s in enumerate(squares)]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the number of its nearest centroid, and the squared distance to it."""
        left = np.zeros(len(vectors), np.int64)
        for low in range(0, len(vectors), _BLOCK):
            block, ahead = vectors[low : low + _BLOCK], left[low : low + _BLOCK]
            for j in range(1, len(self.centroids)):
                # Sums may wrap around; their difference is that of two distances, which fit.
                side = np.einsum("nd,nd->n", block, self.normals[j][ahead]) - self.thresholds[j][ahead]
                ahead[side > 0] = j
        return left, np.sum((vectors - self.centroids[left]) ** 2, axis=1)


def integer_vectors(df: DataFrame, vector: str = "embedding", dimensions: int = 64, scale: int = 256) -> Column:
    """The vector's components times ``scale``, floored; null for a vector that isn't kept (see ``cluster``)."""
    most = largest_component(dimensions) - 1
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * scale)
    fits = F.forall(scaled, lambda x: x.isNotNull() & (F.abs(x) <= most))
    whole = (F.size(vector) == dimensions) & F.coalesce(fits, F.lit(False))
    return F.when(whole, F.transform(scaled, lambda x: F.floor(x).cast("int")))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def _sums(vectors: DataFrame, bisectors: Bisectors) -> dict[int, np.ndarray]:
    """Per cluster that has any, the number of its vectors and the sums of their components."""
    k, dimensions = bisectors.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            nearest, _ = bisectors.nearest(x)
            order = np.argsort(nearest, kind="stable")
            found, first = np.unique(nearest[order], return_index=True)
            if len(found):
                total[found, 1:] += np.add.reduceat(x[order], first, axis=0)
                total[:, 0] += np.bincount(nearest, minlength=k)
        held = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(list(total[held]), pa.list_(pa.int64()))], ["cluster", "sums"])

    parts = vectors.select("vector").mapInArrow(add, "cluster int, sums array<long>")
    # The sums of many tasks may outgrow a long before they are divided.
    summed = parts.select("cluster", F.posexplode("sums").alias("at", "n")).groupBy("cluster", "at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    out: dict[int, list] = {}
    for r in summed.collect():
        out.setdefault(r["cluster"], [0] * (dimensions + 1))[r["at"]] = int(r["n"])
    return out


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dimensions: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Vectors with their clusters, and the clusters.

    The first has ``key``, ``cluster`` and ``distance`` (squared) per kept
    vector; the second, of at most k rows, ``cluster``, ``centroid``, ``size``
    and ``cluster_inertia``.

    Kept are vectors with exactly ``dimensions`` components, none of them null,
    infinite or not a number, nor so large that a squared distance might not fit
    into a long (for 64 components and a scale of 256: beyond 741,000 or so).
    Components are multiplied by ``scale`` and floored. The first centroids are
    the k vectors whose keys have the smallest SHA-256 after ``<seed>:``, in that
    order; rows that share a key count one by one, lesser vectors first, and a
    null key counts as an empty one. Each round assigns the vectors and replaces
    every centroid that has any by their componentwise floored mean. Where fewer than k vectors are kept,
    there are fewer clusters; an empty table has none. Columns of other names don't matter.
    """
    spark = df.sparkSession
    vectors = written(
        df.select(F.col(key).alias("key"), integer_vectors(df, vector, dimensions, scale).alias("vector")).filter("vector is not null"),
        "integer-vectors",
    )
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(hashed, "key", "vector").limit(k).collect()
    centroids = [list(r["vector"]) for r in first]
    for _ in range(rounds if centroids else 0):
        means = list(centroids)
        for number, (held, *sums) in _sums(vectors, Bisectors(np.array(centroids))).items():
            means[number] = [s // held for s in sums]
        if means == centroids:
            break
        centroids = means

    schema = T.StructType(
        [T.StructField("key", vectors.schema["key"].dataType), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    bisectors = Bisectors(np.array(centroids or [[0] * dimensions]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, distance = bisectors.nearest(_matrix(batch.column(1), dimensions))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest, pa.int32()), pa.array(distance)], schema.names)

    assigned = written(vectors.mapInArrow(assign, schema), "assigned-vectors")
    held = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("distance").alias("cluster_inertia"))
    numbered = spark.createDataFrame(list(enumerate(centroids)), "cluster int, centroid array<long>")
    clusters = numbered.join(F.broadcast(held), "cluster", "left").na.fill(0, ["size", "cluster_inertia"])
    return assigned.select(F.col("key").alias(key), "cluster", "distance"), clusters
