"""Product codes of vectors: per part a codebook trained by Lloyd rounds over partition-local cover trees.

1. Each partition turns its vectors into whole numbers, ``floor(1024 * x)``, in blocks of at most ``BLOCK`` rows, and
   builds one cover tree a part over each block (``cover_tree``). Blocks with their trees are written once.
2. The codebooks start as the parts of the vectors with the smallest ids. In a round every block walks its trees,
   and sends per part and entry a count and a vector sum, made from cumulative sums; the sums meet in one
   map-side aggregation. Of a round, the driver holds the codebooks alone (at most 4 * 256 rows).
3. A last walk gives the codes; errors are exact and summed up per label.

Defined cases: rows whose vector is null, or holds null, non-finite or too large components (2**62 must hold a squared
distance), are left out, as are vectors of another length than the first one's (by id) that four divides; fewer
vectors than entries give a shorter codebook; rows of a shared id count each, ties among them by their components;
rows without an id are coded, but start a codebook only where no others are left; an empty table gives an empty
result; extra columns are not read. A block bounds the memory of a task; copies of one vector are a subtree of
radius zero, settled at once.
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
from .cover_tree import CoverTree, assign, build, spread, sums
from .vectors import scaled, squared_pairs, usable, whole, width_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, PARTS, ENTRIES, ROUNDS, BLOCK = 1024, 4, 256, 4, 4096
_NODE = ("start", "end", "centre", "radius", "child", "children")
_HEX = np.array([f"{i:02x}" for i in range(256)])


def _pack(tree: CoverTree) -> dict[str, bytes]:
    small = np.int32 if not tree.points.size or np.abs(tree.points).max() < 2**31 else np.int64
    out = {"points": tree.points.astype(small), "order": tree.order.astype(np.int32)}
    out |= {k: getattr(tree, k).astype(np.float64 if k == "radius" else np.int32) for k in _NODE}
    return {k: v.tobytes() for k, v in out.items()}


def _unpack(t: dict[str, bytes], n: int) -> CoverTree:
    points = np.frombuffer(t["points"], np.int64 if t["wide"] else np.int32)
    node = {k: np.frombuffer(t[k], np.float64 if k == "radius" else np.int32) for k in _NODE}
    node = {k: v if k == "radius" else v.astype(np.int64) for k, v in node.items()}
    return CoverTree(points.reshape(n, -1).astype(np.int64), np.frombuffer(t["order"], np.int32).astype(np.int64), **node)


_TREE = "struct<wide:int,points:binary,order:binary," + ",".join(f"{k}:binary" for k in _NODE) + ">"


def _blocks(width: int, schema: pa.Schema):
    """Batches ``(id, label, vector)`` to blocks ``(ids, labels, trees)``."""
    each = width // PARTS

    def block(ids: list[pa.Array], labels: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(rows)
        trees = []
        for p in range(PARTS):
            t = _pack(build(np.ascontiguousarray(x[:, p * each : (p + 1) * each])))
            trees.append({"wide": int(len(t["points"]) > 4 * len(x) * each)} | t)
        data = [pa.concat_arrays(ids), pa.concat_arrays(labels)]
        ends = pa.array([0, len(x)], pa.int32())
        cols = [pa.ListArray.from_arrays(ends, c).cast(f.type) for c, f in zip(data, schema, strict=False)]
        cols.append(pa.array([trees], schema.field("trees").type))
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows, n = [], [], [], 0
        for batch in batches:
            kept, x = whole(batch.column(2), width, SCALE)
            own = batch.select([0, 1]).take(pa.array(kept))
            at = 0
            while at < len(kept):
                m = min(BLOCK - n, len(kept) - at)
                ids.append(own.column(0).slice(at, m))
                labels.append(own.column(1).slice(at, m))
                rows.append(x[at : at + m])
                n, at = n + m, at + m
                if n == BLOCK:
                    yield block(ids, labels, rows)
                    ids, labels, rows, n = [], [], [], 0
        if n:
            yield block(ids, labels, rows)

    return run


def _trees(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column(0).slice(i, 1).flatten()
            packed = batch.column(2)[i].as_py()
            yield ids, batch.column(1).slice(i, 1).flatten(), [_unpack(t, len(ids)) for t in packed]


def _round(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per part and entry that has points: ``(part, entry, n, s0, s1, ...)``."""
        k, each = books[0].shape
        count, total = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, each), np.int64)
        for _, _, trees in _trees(batches):
            for p, tree in enumerate(trees):
                n, s = sums(tree, assign(tree, books[p])[:3], k)
                count[p] += n
                total[p] += s
        part, entry = np.nonzero(count)
        cols = [part, entry, count[part, entry], *total[part, entry].T]
        names = ["part", "entry", "n", *[f"s{j}" for j in range(each)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in cols], names)

    return run


def _codes(books: list[np.ndarray], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, trees in _trees(batches):
            code, error = np.full(len(ids), "", "<U8"), np.zeros(len(ids), np.int64)
            for p, tree in enumerate(trees):
                e = spread(tree, assign(tree, books[p])[:3])
                code = np.char.add(code, _HEX[e])
                error[tree.order] += squared_pairs(tree.points, books[p][e[tree.order]])
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code.tolist(), pa.string()), pa.array(error)], schema=schema)

    return run


def _schema_of(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def trained(blocks: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` Lloyd rounds over the written blocks."""
    each = books[0].shape[1]
    s = [f"s{j}" for j in range(each)]
    ddl = ", ".join(f"{c} long" for c in ["part", "entry", "n", *s])
    for _ in range(rounds):
        part = blocks.mapInArrow(_round(books), ddl)
        rows = part.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in s]).collect()
        books = [b.copy() for b in books]
        for r in rows:
            books[r.part][r.entry] = [r[c] // r.n for c in s]
    return books


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(vec_id, label, code, error)`` of every usable vector, and the codebooks."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    kind = v.schema["label"].dataType.simpleString()
    ddl = f"vec_id long, label {kind}, code string, error long"
    width = width_of(v, "vec_id", "v", PARTS)
    first = v.where(usable(F.col("v"), SCALE, width)).select("vec_id", scaled(F.col("v"), SCALE).alias("x"))
    seeds = first.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).collect() if width else []
    if not seeds:
        return v.sparkSession.createDataFrame([], ddl), []
    x = np.array([r.x for r in seeds], np.int64)
    books = [np.ascontiguousarray(p) for p in np.split(x, PARTS, axis=1)]
    block_ddl = f"ids array<long>, labels array<{kind}>, trees array<{_TREE}>"
    blocks = written(v.mapInArrow(_blocks(width, _schema_of(block_ddl)), block_ddl), "vector-blocks")
    books = trained(blocks, books)
    return blocks.mapInArrow(_codes(books, _schema_of(ddl)), ddl), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in order, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def code_report(vectors: DataFrame, **columns: str) -> DataFrame:
    """Codes with the error of each vector, of its label as a whole (nulls together), and the codebooks' digest."""
    codes, books = vector_codes(vectors, **columns)
    codes = written(codes, "codes")
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = written(by_label.select(F.col("label").alias("l"), "label_error"), "label-errors")
    joined = codes.join(totals, codes["label"].eqNullSafe(totals["l"]))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
