"""Centroid clustering of integer vectors by a bisector tournament.

Two centroids a < b part space by the plane of the points as near to one as to the other.
For each pair its normal 2(b - a) and its threshold |b|^2 - |a|^2 are worked out once a
round, in integers. A vector goes through a tournament: the winner so far, at first
centroid 0, meets the next number, and the sign of one linear test knocks one of them out;
zero favours the smaller number. k - 1 tests leave the nearest centroid, and only for the
last assignment the distance to it is worked out, exactly.

Each task sums up its own vectors by cluster, so that a round shuffles k rows a task
whatever share of the vectors one cluster holds; the driver sees k sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sendstats.llm.common import materialize

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3:"
# Integer components are held within these bounds (|x| < 131,072), so that no sum of 64
# products leaves 64 bits.
BOUND = 1 << 27


class Bisectors:
    """Normals and thresholds of all pairs of centroids, an integer matrix with a row each."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each vector, of equally near ones the smallest."""
        best = np.zeros(len(vectors), dtype=np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", vectors, self.normals[best, rival]) - self.thresholds[best, rival]
            best[side > 0] = rival
        return best


def integer_vectors(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, v) of the rows with ``components`` components, none of them NULL, NaN or infinite."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(BOUND))), F.lit(-float(BOUND))))
    return embeddings.where((F.size(x) == components) & ~bad).select("vec_id", F.transform(x, whole).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; rows without id come last, ties go by the vector."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(order.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def _matrix(batch: pa.RecordBatch, components: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("v")).flatten().to_numpy().reshape(-1, components)


def _summing(planes: Bisectors, components: int) -> Callable:
    k = len(planes.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, components), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, components)
            best = planes.winners(x)
            np.add.at(sums, best, x)
            counts += np.bincount(best, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(k), components)), pa.array(np.tile(np.arange(components), k)),
             pa.array(sums.reshape(-1)), pa.array(np.repeat(counts, components))],
            names=["cluster", "place", "total", "n"],
        )

    return run


def _assigning(planes: Bisectors, components: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, components)
            best = planes.winners(x)
            away = x - planes.centroids[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best.astype(np.int32)), pa.array((away * away).sum(axis=1))],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floor of the mean of each centroid's vectors; a centroid without any stays."""
    components = centroids.shape[1]
    parts = vectors.mapInArrow(_summing(Bisectors(centroids), components), "cluster bigint, place bigint, total bigint, n bigint")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("total", "n")]
    out = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(*exact).where("n > 0").collect():
        out[r.cluster, r.place] = int(r.total) // int(r.n)
    return out


def centroid_clusters(
    embeddings: DataFrame, components: int = COMPONENTS, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    ``embeddings``: vec_id, embedding. Vectors that are NULL, of another length or hold a NULL,
    NaN or infinite component are left out. Components are floor(1024 x), held within
    +-2^27. The first centroids are the vectors with the smallest hashes of their ids; with fewer
    vectors than clusters there are as many centroids as vectors. Rows without id and repeated rows
    count like others, and an empty table gives no rows. Sums of distances beyond 64 bits are NULL.
    Other columns are not carried.
    """
    spark = embeddings.sparkSession
    vectors = materialize(integer_vectors(embeddings.select("vec_id", "embedding"), components), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((1, components), dtype=np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    assigned = vectors.mapInArrow(_assigning(Bisectors(centroids), components), f"vec_id {kind}, cluster int, distance bigint")
    assigned = materialize(assigned, "assigned")
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    about = [
        (i, fits(sums.get(i, 0)), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    named = spark.createDataFrame(about, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # Broadcast: one row for each centroid.
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
