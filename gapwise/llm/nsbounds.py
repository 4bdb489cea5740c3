"""Clusters around centroids, with distances kept as bounds (ns-bounds)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.scratch import discard, materialize

DIM = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
# Largest component, so that a squared distance over all of them fits 63 bits.
LARGEST = 2**62
_ROWS = 4096  # vectors that a task compares at once


def grid_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE
) -> DataFrame:
    """``vec_id`` and ``point``, the components as integers floor(scale * x), of the vectors with
    exactly ``dim`` components, none of them null or non-finite.

    A component so large that a squared distance would leave 63 bits is an error.
    """
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    usable = (F.size(vector) == dim) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    limit = int((LARGEST // dim) ** 0.5 / 2)
    scaled = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    fits = F.forall(x, lambda v: F.abs(v) * scale < limit)
    too_large = F.raise_error(F.lit(f"a scaled component beyond {limit} has no distance in 63 bits"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"),
        F.when(fits, scaled).otherwise(too_large).alias("point"),
    )


def first_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The ``k`` points, or fewer if there are fewer, with the smallest SHA-256 of
    "<seed>:<vec_id>" in ascending order; rows without identifier come last, ties by components."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.select(place.alias("_place"), "point").orderBy(F.col("_place").asc_nulls_last(), "point")
    found = [r.point for r in rows.limit(k).collect()]
    return np.array(found, np.int64)


def _matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def _squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows to one centroid, or to one centroid each."""
    away = points - centroid
    return (away * away).sum(axis=1)


class _History:
    """Centroids of all rounds, and how far each has come since any of them."""

    def __init__(self, rounds: np.ndarray):
        self.rounds = rounds
        self.now = rounds[-1]
        # The norm of the whole way, not the sum of the ways of each round.
        self.moved = np.sqrt(((rounds - rounds[-1]).astype(float) ** 2).sum(axis=2))


def _assign(rounds: np.ndarray, first: bool):
    """Rows (vec_id, point, cluster, bounds, since) with the nearest of the newest centroids.

    ``bounds`` has the distance to each centroid when it was last computed, and ``since`` the round
    of that.  A centroid cannot be nearer now than that distance less its displacement since then.
    """
    history = _History(rounds)
    now, k, at = history.now, len(history.now), len(rounds) - 1
    dim = now.shape[1]

    def assigned(points: np.ndarray, cluster: np.ndarray, bounds: np.ndarray, since: np.ndarray) -> np.ndarray:
        rows = np.arange(len(points))
        if first:
            stale = np.ones((len(points), k), bool)
        else:
            moved = history.moved[since, np.arange(k)]
            low = bounds - moved
            high = bounds[rows, cluster] + moved[rows, cluster]
            # A margin for rounding: distances are doubles.  Whatever may be as near is looked at.
            near = low <= high[:, None] * (1 + 1e-9) + 1e-6
            near[rows, cluster] = False
            open_rows = near.any(axis=1)
            # The own centroid, computed again, may settle what its upper bound left open.
            at_own = np.flatnonzero(open_rows)
            own = np.sqrt(_squared(points[at_own], now[cluster[at_own]]).astype(float))
            bounds[at_own, cluster[at_own]] = own
            since[at_own, cluster[at_own]] = at
            stale = np.zeros((len(points), k), bool)
            stale[at_own] = low[at_own] <= own[:, None] * (1 + 1e-9) + 1e-6
            stale[at_own, cluster[at_own]] = True
            stale[~(stale.sum(axis=1) > 1)] = False
        best = np.full(len(points), np.iinfo(np.int64).max)
        nearest = cluster.copy()
        for j in range(k):  # in ascending order, so that the smaller number wins a tie
            some = np.flatnonzero(stale[:, j])
            exact = _squared(points[some], now[j])
            bounds[some, j] = np.sqrt(exact.astype(float))
            since[some, j] = at
            better = exact < best[some]
            best[some[better]] = exact[better]
            nearest[some[better]] = j
        return nearest

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                n = part.num_rows
                points = _matrix(part.column("point"), dim, np.int64)
                if first:
                    cluster = np.zeros(n, np.int64)
                    bounds, since = np.zeros((n, k)), np.zeros((n, k), np.int64)
                else:
                    cluster = part.column("cluster").to_numpy().astype(np.int64)
                    bounds = _matrix(part.column("bounds"), k, float).copy()
                    since = _matrix(part.column("since"), k, np.int64).copy()
                nearest = assigned(points, cluster, bounds, since)
                ends = pa.array(np.arange(n + 1) * k, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("point"),
                        pa.array(nearest, pa.int32()),
                        pa.ListArray.from_arrays(ends, pa.array(bounds.ravel())),
                        pa.ListArray.from_arrays(ends, pa.array(since.ravel(), pa.int32())),
                        pa.array(_squared(points, now[nearest])),
                    ],
                    names=["vec_id", "point", "cluster", "bounds", "since", "distance"],
                )

    return of


_STATE = "vec_id long, point array<long>, cluster int, bounds array<double>, since array<int>, distance long"


def _moved(state: DataFrame, now: np.ndarray) -> np.ndarray:
    """Each centroid at the exact floor of the mean of its points; one without points stays.

    Sums combine in the tasks, so a cluster of any size is one row per task in the shuffle.
    """
    dim = now.shape[1]
    # Sums of 62-bit numbers may leave 63 bits: a decimal holds them for any number of rows.
    sums = [F.sum(F.col("point")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]
    moved = now.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # k rows
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dim)]
    return moved


def ns_bounds_clusters(
    points: DataFrame, start: np.ndarray, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """Points (``vec_id``, ``point``) with ``cluster`` and ``distance``, the squared distance to the
    final centroid, and the final centroids, after ``rounds`` rounds from the centroids ``start``.

    The result is that of comparing every vector with every centroid in every round; ties go to the
    smaller number.  A vector keeps, per centroid, the last computed distance and its round.  All
    centroids of all rounds are kept (rounds x k x components, a few hundred KB), so a bound is
    loosened by the distance between where the centroid is and where it was then.  Only centroids
    whose bound does not rule them out are computed again, exactly.

    Every round reads the state of the round before and writes its own, without a shuffle; only the
    sums per cluster are shuffled.  A state is removed when the next one is written.  Without
    centroids there are no points either, and the result is empty.
    """
    if not len(start):
        none = points.limit(0).withColumns({"cluster": F.lit(0), "distance": F.lit(0).cast("long")})
        return none, start
    history, state = start[None], points
    for step in range(rounds + 1):
        before, state = state, materialize(state.mapInArrow(_assign(history, step == 0), _STATE), "clusters")
        if step:
            discard(before)
        if step < rounds:
            history = np.concatenate([history, _moved(state, history[-1])[None]])
    return state.select("vec_id", "point", "cluster", "distance"), history[-1]


def clustered(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    dim: int = DIM,
    scale: int = SCALE,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """Every usable vector (see ``grid_vectors``) with its ``cluster``, ``distance``,
    ``cluster_inertia`` and ``inertia``, the distances summed over its cluster and over all, and
    ``centroid_sha256`` of its final centroid.

    Rows with one identifier, or equal ones, are vectors like any others.  Other columns are
    ignored.  The centroids are few: they and the figures per cluster (``k`` rows) are all that
    reaches the driver.
    """
    points = materialize(grid_vectors(vectors, key, vector, dim, scale), "points")
    placed, centroids = ns_bounds_clusters(points, first_centroids(points, k, seed), rounds)
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum"))
    inertia = {r["cluster"]: int(r["sum"]) for r in sums.collect()}  # k rows
    figures = [
        (j, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for j, n in inertia.items()
    ]
    table = vectors.sparkSession.createDataFrame(
        figures, "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(table), F.col("cluster") == F.col("_cluster")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
