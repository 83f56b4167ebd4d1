"""Centroid clustering of vectors with bounds on the norm of total displacement.

Every vector keeps, for each centroid, its distance when that was last evaluated and the round of
that evaluation. Centroids of all rounds are kept (they are few), so a stored distance is loosened
by how far its centroid is now from where it was then: the norm of the summed displacement, never
more than the sum of the norms of the rounds between. A vector whose loosened bounds leave no doubt
keeps its centroid without an evaluation; the others are evaluated exactly, in whole numbers.

The state of a round is derived from that of the round before by a narrow map, and cached. A lost
executor's part is made again from the table by replaying the rounds, so nothing is written but
the result. Only vectors that change their centroid contribute to the sums of a round; they are
added up in each task and then by Spark, and one row for each centroid reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidings.llm.tables import stored

#: Components are held within these bounds, so that a squared distance of 64 of them fits a long.
LIMIT = 1 << 27
#: Stored distances have 24 bits; bounds give way by more than their rounding.
_LOOSE = 1e-6

_STATE = "vec_id long, vector binary, cluster int, earlier int, bounds binary, rounds binary"


@dataclass(frozen=True)
class Clusters:
    """Result of :func:`cluster`: ``vectors`` (vec_id, cluster, distance) and the final centroids."""

    vectors: DataFrame
    centroids: list[list[int]]


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none of them null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == dims) & finite


def whole_components(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the components x of usable vectors, held within ``LIMIT``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64).reshape(-1, dims)


def squared_distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of whole vectors from one centroid."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def assign(
    vectors: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, rounds: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """The nearest of the centroids ``history[-1]`` for each vector; of equally near the first.

    ``cluster`` (of the round before), ``bounds`` (distances when evaluated) and ``rounds`` (when
    that was) are those of :data:`_STATE`; bounds and rounds are brought up to date in place. Also
    returns how many distances were evaluated.
    """
    now, k = len(history) - 1, history.shape[1]
    # How far each centroid is now from its place in each round: the norm of all displacement since.
    moved = np.sqrt(((history[-1][None] - history).astype(np.float64) ** 2).sum(axis=2)).T * (1 + _LOOSE)
    drift = moved[np.arange(k), rounds]
    rows = np.arange(len(vectors))
    upper = bounds[rows, cluster] * (1 + _LOOSE) + drift[rows, cluster]
    lower = bounds * (1 - _LOOSE) - drift
    lower[rows, cluster] = np.inf
    doubtful = np.flatnonzero(upper >= lower.min(axis=1, initial=np.inf))
    out, evaluated = cluster.copy(), 0
    if not len(doubtful):
        return out, evaluated
    some, own = vectors[doubtful], cluster[doubtful]
    exact = np.full((len(doubtful), k), np.iinfo(np.int64).max)
    for j in range(k):
        at = np.flatnonzero(own == j)
        exact[at, j] = squared_distances(some[at], history[-1][j])
        evaluated += len(at)
    near = np.sqrt(exact[np.arange(len(doubtful)), own].astype(np.float64)) * (1 + _LOOSE)
    for j in range(k):
        at = np.flatnonzero((own != j) & (lower[doubtful, j] <= near))
        exact[at, j] = squared_distances(some[at], history[-1][j])
        evaluated += len(at)
    row, j = np.nonzero(exact < np.iinfo(np.int64).max)
    bounds[doubtful[row], j] = np.sqrt(exact[row, j].astype(np.float64))
    rounds[doubtful[row], j] = now
    out[doubtful] = exact.argmin(axis=1)
    return out, evaluated


def _packed(rows: np.ndarray) -> pa.Array:
    """The rows of an array as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = pa.array(np.arange(len(rows) + 1) * width, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(rows.tobytes())])


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _batch(ids: pa.Array, vectors: np.ndarray, cluster: np.ndarray, earlier: np.ndarray, bounds: np.ndarray, rounds: np.ndarray):
    return pa.RecordBatch.from_arrays(
        [
            ids,
            _packed(vectors.astype("<i4")),
            pa.array(cluster, pa.int32()),
            pa.array(earlier, pa.int32()),
            _packed(bounds.astype("<f4")),
            _packed(rounds.astype("<u2")),
        ],
        ["vec_id", "vector", "cluster", "earlier", "bounds", "rounds"],
    )


def _started(vectors: DataFrame, history: np.ndarray, scale: int) -> DataFrame:
    """The state of the first assignment, in which every distance is evaluated."""
    dims, k = history.shape[2], history.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = whole_components(batch.column(1), dims, scale)
            exact = np.stack([squared_distances(whole, history[0][j]) for j in range(k)], axis=1)
            cluster = exact.argmin(axis=1)
            yield _batch(batch.column(0), whole, cluster, np.full(len(whole), -1), np.sqrt(exact), np.zeros((len(whole), k)))

    return vectors.mapInArrow(run, _STATE)


def _advanced(state: DataFrame, history: np.ndarray) -> DataFrame:
    """The state after one more assignment, to the centroids ``history[-1]``."""
    dims, k = history.shape[2], history.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unpacked(batch.column(1), "<i4", dims).astype(np.int64)
            bounds = _unpacked(batch.column(4), "<f4", k).astype(np.float64)
            rounds = _unpacked(batch.column(5), "<u2", k).astype(np.int64)
            earlier = batch.column(2).to_numpy().astype(np.int64)
            cluster, _ = assign(vectors, earlier, bounds, rounds, history)
            yield _batch(batch.column(0), vectors, cluster, earlier, bounds, rounds)

    return state.mapInArrow(run, _STATE)


def _changes(state: DataFrame, dims: int, k: int) -> np.ndarray:
    """What the vectors that changed their centroid add to, and take from, each count and sum: k rows of 1 + dims."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 1 + dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unpacked(batch.column(0), "<i4", dims).astype(np.int64)
            for column, sign in ((1, 1), (2, -1)):
                cluster = batch.column(column).to_numpy()
                for j in np.unique(cluster[cluster >= 0]).tolist():
                    own = cluster == j
                    total[j, 0] += sign * int(own.sum())
                    total[j, 1:] += sign * vectors[own].sum(axis=0)
        told = np.flatnonzero(total.any(axis=1))
        if len(told):
            names = ["cluster", *[f"s{i}" for i in range(1 + dims)]]
            yield pa.RecordBatch.from_arrays([pa.array(told, pa.int32()), *[pa.array(total[told, i]) for i in range(1 + dims)]], names)

    columns = [f"s{i}" for i in range(1 + dims)]
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in columns]])
    changed = state.where("cluster <> earlier").select("vector", "cluster", "earlier")
    sums = changed.mapInArrow(run, schema).groupBy("cluster").agg(*[F.sum(c).alias(c) for c in columns])
    out = np.zeros((k, 1 + dims), np.int64)
    for row in sums.collect():  # at most k rows
        out[row["cluster"]] = [row[c] for c in columns]
    return out


def seeded_centroids(vectors: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The vectors with the ``k`` smallest SHA-256 of ``seed:vec_id``; of equal ids the smaller vector."""
    named = vectors.where("vec_id is not null").withColumn("order", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = [row["vector"] for row in named.orderBy("order", "vector").limit(k).collect()]
    dims = len(first[0]) if first else 0
    return whole_components(pa.array(first, pa.list_(pa.float64())), dims, scale) if first else np.empty((0, 0), np.int64)


def cluster(
    table: DataFrame, vector: str = "embedding", k: int = 8, dims: int = 64, rounds: int = 10, scale: int = 1024, seed: int = 3
) -> Clusters:
    """``table`` (vec_id, ``vector``) assigned to ``k`` centroids after ``rounds`` rounds.

    Vectors without exactly ``dims`` components, or with a null or not finite one, are left out;
    the others have whole components floor(``scale`` * x), held within 2**27 on either side. A round
    assigns every vector to its nearest centroid (of equally near the first) and moves each
    centroid that has vectors to the floor of their mean. Repeated rows are vectors of their own. A
    vector without vec_id takes part but is never a first centroid; with fewer than ``k`` vectors
    that have one there are as many centroids, and with none no rows. Further columns are ignored.
    """
    named = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    vectors = named.where(usable(F.col("vector"), dims))
    first = seeded_centroids(vectors, k, seed, scale)
    k = len(first)
    if not k:
        empty = table.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clusters(empty, [])
    history = first[None]
    sums = np.zeros((k, 1 + dims), np.int64)
    state, older = _started(vectors, history, scale), None
    for _ in range(rounds):
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        sums += _changes(state, dims, k)
        if older is not None:
            older.unpersist()
        moved = history[-1].copy()
        held = sums[:, 0] > 0
        moved[held] = sums[held, 1:] // sums[held, :1]
        history = np.concatenate([history, moved[None]])
        older, state = state, _advanced(state, history)
    last = history[-1]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = _unpacked(batch.column(1), "<i4", dims).astype(np.int64)
                own = last[batch.column(2).to_numpy()] - whole
                exact = np.einsum("ij,ij->i", own, own)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(exact)], ["vec_id", "cluster", "distance"])

    measured = state.select("vec_id", "vector", "cluster").mapInArrow(measure, "vec_id long, cluster int, distance long")
    result = stored(measured, "clusters")
    if older is not None:
        older.unpersist()
    return Clusters(result, [[int(x) for x in row] for row in last])


def with_inertia(found: Clusters) -> DataFrame:
    """The vectors of ``found`` with cluster_inertia, inertia (sums of distances; null beyond a long)
    and centroid_sha256, the digest of the final centroid's components."""
    spark = found.vectors.sparkSession
    digests = [(j, ",".join(map(str, c))) for j, c in enumerate(found.centroids)]
    named = spark.createDataFrame(digests, "cluster int, components string")
    own = found.vectors.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    total = own.agg(F.try_sum("cluster_inertia")).scalar().alias("inertia")
    about = named.join(own, "cluster").select("cluster", "cluster_inertia", total, F.sha2("components", 256).alias("centroid_sha256"))
    joined = found.vectors.join(F.broadcast(about), "cluster")  # at most k rows
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
