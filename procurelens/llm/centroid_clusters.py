"""Lloyd's clustering of integer vectors, with lower bounds that geometry loosens less than a full drift.

Every vector carries an upper bound of the distance to its own centroid and a lower bound of the
distance to each other one. All members of a cluster lie in a ball round its centroid. When another
centroid moves from ``a`` to ``b``, a point ``x`` can come nearer to it by ``|x - a| - |x - b|`` only, which is
at most ``|b - a| sin(e)``, ``e`` being the elevation of ``x`` above the plane half-way between ``a`` and ``b``,
seen from the middle ``m`` of both (``|x - a| + |x - b| >= 2 |x - m|``). The highest elevation in the ball is found in
the plane through its centre, ``a`` and ``b``: the centre's elevation plus ``asin(radius / distance)``. Lower
bounds fall by that, or rise if the whole ball is left behind, instead of falling by ``|b - a|``.

Only vectors whose bounds meet are compared with centroids, in exact integers.
Spark holds the vectors with their bounds; the driver holds the centroids, ``clusters`` times
``dimensions`` integers, and sums of these come from aggregates of the vectors that changed cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import drop, saved, saved_at

STATE = "vec_id long, vector binary, cluster int, was int, upper double, lower binary"
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")
#: Largest magnitude of a component, so that a squared distance of 64 components fits a long.
LARGEST = 1 << 27
#: Bounds count as met within this, relative to their size: far above what rounding can do.
SLACK = 1e-9


class Step(NamedTuple):
    """Centroids, how far each moved, and how far ``loosen[i, j]`` members of ``i`` may have come nearer to ``j``."""

    centres: np.ndarray
    drift: np.ndarray
    loosen: np.ndarray


def loosening(old: np.ndarray, new: np.ndarray, centre: np.ndarray, radius: float) -> float:
    """The most by which the distance to a centroid that moves from ``old`` to ``new`` falls, over a ball's points.

    Negative if it rises for all of them.
    """
    move = new - old
    length = float(np.linalg.norm(move))
    if length == 0:
        return 0.0
    offset = centre - (old + new) / 2
    far = float(np.linalg.norm(offset))
    height = float(offset @ move) / length
    if height + radius < 0:
        return 2 * length * (height + radius) / (2 * (far + radius) + length)
    if far <= radius:
        return length
    elevation = np.arcsin(np.clip(height / far, -1, 1)) + np.arcsin(radius / far)
    return length * float(np.sin(min(elevation, np.pi / 2)))


def moved(before: np.ndarray, after: np.ndarray, radii: np.ndarray) -> Step:
    """The step from centroids ``before``, whose members lie within ``radii`` of them, to ``after``."""
    old, new = before.astype(float), after.astype(float)
    loosen = np.array([[loosening(old[j], new[j], old[i], radii[i]) for j in range(len(old))] for i in range(len(old))])
    return Step(after, np.linalg.norm(new - old, axis=1), loosen)


def squared(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column for each centroid."""
    out = np.empty((len(vectors), len(centres)), np.int64)
    for j, centre in enumerate(centres):
        apart = vectors - centre
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def assign(vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray,
           step: Step) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters, upper and lower bounds after a step, and how many vectors were compared with every centroid."""
    rows = np.arange(len(vectors))
    upper = upper + step.drift[cluster]
    lower = lower - step.loosen[cluster]

    def met(at: np.ndarray) -> np.ndarray:
        others = lower[at]
        others[np.arange(len(at)), cluster[at]] = np.inf
        return at[upper[at] * (1 + SLACK) + SLACK >= others.min(axis=1) * (1 - SLACK)]

    open_ = met(rows)
    apart = vectors[open_] - step.centres[cluster[open_]]
    upper[open_] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
    open_ = met(open_)
    exact = squared(vectors[open_], step.centres)
    cluster = cluster.copy()
    cluster[open_] = exact.argmin(axis=1)  # of equal ones the smallest number
    lower[open_] = np.sqrt(exact)
    upper[open_] = np.sqrt(exact.min(axis=1, initial=np.iinfo(np.int64).max))
    return cluster, upper, lower, len(open_)


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * values)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ValueError(f"a component times {scale} reaches {LARGEST}: squared distances would not fit a long")
    return out.astype(np.int64)


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary cells of equal size as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def _cells(matrix: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in matrix], pa.binary())


def _state(ids: pa.Array, vectors: pa.Array, cluster, was, upper, lower) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, vectors, pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(upper, pa.float64()),
         _cells(lower)], names=["vec_id", "vector", "cluster", "was", "upper", "lower"])


def _first(centres: np.ndarray, scale: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = integers(values.reshape(-1, dimensions), scale)
            exact = squared(vectors, centres)
            cluster = exact.argmin(axis=1)
            lower = np.sqrt(exact)
            yield _state(batch.column("vec_id"), _cells(vectors.astype(np.int32)), cluster, np.full(len(cluster), -1),
                         lower[np.arange(len(cluster)), cluster], lower)

    return run


def _next(step: Step, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("vector")
            vectors = _matrix(packed, np.int32, dimensions).astype(np.int64)
            was = batch.column("cluster").to_numpy()
            cluster, upper, lower, _ = assign(vectors, was, batch.column("upper").to_numpy(),
                                              _matrix(batch.column("lower"), np.float64, len(step.centres)), step)
            yield _state(batch.column("vec_id"), packed, cluster, was, upper, lower)

    return run


def _changes(clusters: int, dimensions: int):
    """What vectors that changed cluster add to sums of the new one and take from the old one, once for each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(clusters, np.int64)
        total = np.zeros((clusters, dimensions), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"), np.int32, dimensions).astype(np.int64)
            for name, sign in (("cluster", 1), ("was", -1)):
                number = batch.column(name).to_numpy()
                for j in np.unique(number[number >= 0]):
                    count[j] += sign * int((number == j).sum())
                    total[j] += sign * vectors[number == j].sum(axis=0)
        flat = np.hstack([count[:, None], total])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(clusters), dimensions + 1), pa.int32()),
             pa.array(np.tile(np.arange(dimensions + 1), clusters), pa.int32()), pa.array(flat.ravel())],
            names=["cluster", "place", "change"])

    return run


def _distances(centres: np.ndarray, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), np.int32, dimensions).astype(np.int64)
            apart = vectors - centres[batch.column("cluster").to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(np.einsum("ij,ij->i", apart, apart))],
                names=["vec_id", "cluster", "distance"])

    return run


class Clusters(NamedTuple):
    """``vectors(vec_id, cluster, distance)``, a saved table, and the final centroids."""

    vectors: DataFrame
    centres: np.ndarray


def usable(embeddings: DataFrame, dimensions: int) -> DataFrame:
    """``(vec_id, vector)`` of rows with exactly ``dimensions`` finite components."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above all
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
            .where((F.size("vector") == dimensions) & finite))


def cluster(embeddings: DataFrame, clusters: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024,
            salt: str = "3:") -> Clusters | None:
    """Cluster the vectors of ``embeddings(vec_id, embedding)``; None if there are none.

    Components become ``floor(scale * x)``. Centroids start as the vectors with the smallest sha256 of ``salt`` and id
    (ties: smaller components first; vectors without an id never). Each of ``rounds`` assigns all vectors (ties:
    smaller number) and replaces each centroid with members by the floor of their mean; then they are assigned
    again. With fewer vectors than ``clusters`` there are as many clusters as vectors. Rows that repeat count as
    often as they come. A component too large for exact distances is an error.
    """
    spark = embeddings.sparkSession
    kept = usable(embeddings, dimensions)
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    starts = kept.where("vec_id is not null").orderBy(digest, "vec_id", "vector").limit(clusters).collect()  # `clusters` rows
    if not starts:
        return None
    centres = integers(np.array([r["vector"] for r in starts]), scale)
    count, total = [0] * len(centres), [[0] * dimensions for _ in centres]
    state, path = saved_at(kept.mapInArrow(_first(centres, scale, dimensions), STATE), "cluster-state")
    for _ in range(rounds):
        changes = (state.where("cluster <> was").mapInArrow(_changes(len(centres), dimensions), "cluster int, place int, change long")
                   .groupBy("cluster", "place").agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("change")))
        for row in changes.collect():  # clusters * (dimensions + 1) rows
            if row["place"]:
                total[row["cluster"]][row["place"] - 1] += int(row["change"])
            else:
                count[row["cluster"]] += int(row["change"])
        radii = np.zeros(len(centres))
        for row in state.groupBy("cluster").agg(F.max("upper").alias("radius")).collect():  # a row for each cluster
            radii[row["cluster"]] = row["radius"]
        after = np.array([[t // n for t in sums] if n else centre.tolist()
                          for centre, n, sums in zip(centres, count, total, strict=True)], np.int64)
        step = moved(centres, after, radii * (1 + SLACK) + SLACK)
        centres = after
        if not step.drift.any():
            break  # the next rounds would change nothing
        old = path
        state, path = saved_at(state.mapInArrow(_next(step, dimensions), STATE), "cluster-state")
        drop(spark, old)
    found = saved(state.mapInArrow(_distances(centres, dimensions), "vec_id long, cluster int, distance long"), "clusters")
    drop(spark, path)
    return Clusters(found, centres)


def inertia_report(embeddings: DataFrame, **parameters) -> DataFrame:
    """One row for each clustered vector: cluster, squared distance, its sums, and a digest of the cluster's centroid."""
    spark: SparkSession = embeddings.sparkSession
    found = cluster(embeddings, **parameters)
    if found is None:
        return spark.createDataFrame([], RESULT)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centres]
    sums = found.vectors.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    whole = sums.agg(F.sum("sum").cast("long").alias("inertia"))
    named = sums.select(F.col("cluster").alias("number"), F.col("sum").cast("long").alias("cluster_inertia"),
                        F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256"))
    known = named.crossJoin(F.broadcast(whole))  # a row for each cluster and one row
    return found.vectors.join(F.broadcast(known), F.col("cluster") == F.col("number")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
