"""Vectors as whole numbers: which rows count, their scaling, and exact squared distances."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def largest(width: int) -> int:
    """Largest size of a component for which squared distances over ``width`` components fit 62 bits."""
    return int((2**62 / max(width, 1)) ** 0.5) // 2


def usable(vector: Column, scale: int, width: int) -> Column:
    """Not null, ``width`` components, none null, not finite, or too large for exact 64-bit distances."""
    bound = float(largest(width)) / scale
    fine = F.forall(vector, lambda x: F.coalesce((F.abs(x.cast("double")) < bound) & ~F.isnan(x), F.lit(False)))
    return F.coalesce((F.size(vector) == width) & fine, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def width_of(df: DataFrame, id_col: str, vec_col: str, parts: int = 1) -> int:
    """Components of the vector with the smallest id (nulls last) among those that can be cut into ``parts`` equal
    parts; 0 where there is none."""
    some = df.where((F.size(vec_col) > 0) & (F.size(vec_col) % parts == 0))
    row = some.agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), F.size(vec_col).alias("n"))).alias("x")).first()
    return row.x.n if row.x is not None else 0


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column have ``width`` components without nulls, and these rows as doubles."""
    if not len(column):
        return np.empty(0, bool), np.empty((0, width))
    lists = column.cast(pa.list_(pa.float64()))
    offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
    size = np.diff(offsets)
    ok = np.asarray(lists.is_valid()) & (size == width)
    values = np.asarray(lists.values.fill_null(np.nan), dtype=np.float64)
    at = offsets[:-1][ok][:, None] + np.arange(width)
    x = values[at] if ok.any() else np.empty((0, width))
    return ok, x


def whole(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of a batch, and their scaled whole components."""
    ok, x = matrix(column, width)
    fine = (np.abs(x) < float(largest(width)) / scale).all(axis=1)
    return np.flatnonzero(ok)[fine], np.floor(x[fine] * scale).astype(np.int64)


def squared(x: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances ``[n, k]`` of whole points and whole entries.

    Where every intermediate value is below 2**53, a product of doubles is exact; beyond, 64-bit integers are used.
    """
    if not len(x) or not len(e):
        return np.empty((len(x), len(e)), np.int64)
    peak = 2.0 * max(np.abs(x).max(), np.abs(e).max())
    if x.shape[1] * peak * peak < 2.0**53:
        a, b = x.astype(np.float64), e.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in e], axis=1)


def squared_pairs(x: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` and ``e``, one by one."""
    d = x - e
    return np.einsum("ij,ij->i", d, d)
