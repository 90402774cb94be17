"""Centroid clustering by a table of distances to fixed pivots (LAESA).

1. Vectors become whole numbers, ``floor(64 * x)``. The first centroids also serve as the fixed pivots: the distance
   of every vector to each pivot is computed once and written beside the vector.
2. In a round, ``max_j |d(v, p_j) - d(c, p_j)|`` bounds the distance of vector and centroid from below, from the table
   and one small matrix alone. The centroid of the least bound is measured exactly; only those whose bound does not
   pass that distance survive and are measured exactly too, in integers. The bounds have a margin for rounding.
3. Partitions send counts and vector sums per centroid; of a round the driver holds the centroids alone.

Defined cases: vectors that are null, not of ``WIDTH`` components, or hold null, non-finite or too large components
(2**62 must hold a squared distance) are left out; rows of a shared id count each, and the first centroids take them
in the order of their components; rows without an id are clustered, but start a centroid only where no others are
left; fewer vectors than centroids give fewer centroids; ties go to the smaller number; an empty table gives an empty
result; extra columns are not read. Batches bound the memory of a task; nothing is grouped by cluster but sums.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import scaled, squared, squared_pairs, usable, whole

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, WIDTH, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, 1
_SLACK = 1e-9


def nearest(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """``(cluster, squared distance, number of exact distances)`` of the rows of ``x``, whose distances to the pivots
    are ``table``."""
    n, k = len(x), len(centroids)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    to_pivots = np.sqrt(squared(centroids, pivots).astype(np.float64))
    bound = np.zeros((n, k))
    for j in range(len(pivots)):
        np.maximum(bound, np.abs(table[:, j : j + 1] - to_pivots[:, j]), out=bound)
    rows = np.arange(n)
    first = bound.argmin(1)
    exact = np.full((n, k), np.iinfo(np.int64).max)
    exact[rows, first] = squared_pairs(x, centroids[first])
    limit = np.sqrt(exact[rows, first].astype(np.float64)) * (1 + _SLACK) + _SLACK * (1 + table.max(1))
    left = bound <= limit[:, None]
    left[rows, first] = False
    a, b = np.nonzero(left)
    exact[a, b] = squared_pairs(x[a], centroids[b])
    cluster = exact.argmin(1)
    return cluster, exact[rows, cluster], n + len(a)


def _tabled(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(vec_id, v)`` to ``(vec_id, x, pivot distances)``, usable vectors only."""
        for batch in batches:
            kept, x = whole(batch.column(1), WIDTH, SCALE)
            d = np.sqrt(squared(x, pivots).astype(np.float64))
            lists = [_lists(pa.array(x.ravel()), len(kept)), _lists(pa.array(d.ravel()), len(kept))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), *lists], ["vec_id", "x", "d"])

    return run


def _lists(flat: pa.Array, n: int) -> pa.Array:
    each = len(flat) // n if n else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * each), flat)


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        if batch.num_rows:
            x, d = (np.asarray(batch.column(i).flatten()).reshape(batch.num_rows, -1) for i in (1, 2))
            yield batch.column(0), x, d


def _round(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per centroid that has vectors: ``(cluster, n, s0, s1, ...)``."""
        k = len(centroids)
        count, total = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for _, x, d in _rows(batches):
            cluster = nearest(x, d, centroids, pivots)[0]
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, x)
        has = np.flatnonzero(count)
        cols = [has, count[has], *total[has].T]
        names = ["cluster", "n", *[f"s{j}" for j in range(WIDTH)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in cols], names)

    return run


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, d in _rows(batches):
            cluster, distance, _ = nearest(x, d, centroids, pivots)
            cols = [ids, pa.array(cluster.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` of every usable vector, as a written table, and the centroids."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    key = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    first = v.where(usable(F.col("v"), SCALE, WIDTH)).select(key.alias("key"), scaled(F.col("v"), SCALE).alias("x"))
    seeds = first.orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    if not seeds:
        empty = v.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long")
        return empty, np.empty((0, WIDTH), np.int64)
    pivots = centroids = np.array([r.x for r in seeds], np.int64)
    table = written(v.mapInArrow(_tabled(pivots), "vec_id long, x array<long>, d array<double>"), "pivot-table")
    s = [f"s{j}" for j in range(WIDTH)]
    ddl = ", ".join(f"{c} long" for c in ["cluster", "n", *s])
    for _ in range(rounds):
        part = table.mapInArrow(_round(centroids, pivots), ddl)
        moved = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in s]).collect()
        centroids = centroids.copy()
        for r in moved:
            centroids[r.cluster] = [r[c] // r.n for c in s]
    out = table.mapInArrow(_assigned(centroids, pivots), "vec_id long, cluster int, distance long")
    return written(out, "clusters"), centroids


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """Clusters and distances, with the inertia of the cluster and of all, and the digest of the cluster's centroid."""
    found, centroids = cluster_vectors(vectors, **options)
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # one row a centroid, so this side of the join has a fixed size
    rows = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
        for c, x in enumerate(centroids.tolist())
        if c in inertia
    ]
    ddl = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(found.sparkSession.createDataFrame(rows, ddl)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
