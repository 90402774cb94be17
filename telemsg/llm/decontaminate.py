"""Benchmark decontamination by q-gram lemma filtering.

Two texts within ``k`` edits share at least ``m + 1 - q (k + 1)`` of the ``q``-grams of the shorter one's ``m``
characters, and those lie on diagonals that spread over at most ``k``. For a block of benchmark items an index from
q-gram to (item, position) is sent to the tasks; a task cuts the characters of its documents into q-grams, looks
them up, and counts the shared ones per document, item and diagonal band. Bands are ``2 (k + 1)`` wide and overlap
by half, so each spread of ``k`` lies whole in one. Bands that meet the bound become regions, and banded alignment
of the item against the region decides: a leak is a place where the whole item occurs with at most ``k`` edits.

Characters are code points after lower-casing A-Z and turning white-space runs into one space. The benchmark is the
stated query set: it is read in blocks of bounded size, each run against all documents; documents are not shuffled.

Defined cases: null or empty texts have no leaks; an item of fewer than ``q`` characters, null included, has no
q-gram and matches nothing; a shorter item's budget is cut so that the bound stays at least one; repeated documents
are reported each, repeated items once; null ids pass through; empty tables give no rows; extra columns are not
read. A text is scanned in pieces that overlap by more than an item, so memory does not grow with its length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .textbytes import IS_SPACE, chunks, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KIND = "doc_id long, item_id long, start long, end long, edits int, budget int"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
    + [("edits", pa.int32()), ("budget", pa.int32())]
)
_BLOOM = 22
_K = 0x9E3779B97F4A7C15


def normal(points: np.ndarray, edges: np.ndarray):
    """Normalised code points of many texts, the index of each in ``points``, and the new text edges."""
    small = points < 128
    space = np.zeros(len(points), bool)
    space[small] = IS_SPACE[points[small]]
    out = np.where((points >= 65) & (points <= 90), points + np.uint32(32), points)
    out[space] = 32
    first = np.zeros(len(points) + 1, bool)
    first[edges] = True
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first white space after a word stays
    keep &= ~(space & first[:-1])
    at = np.flatnonzero(keep)
    return out[at], at, np.searchsorted(at, edges)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return points, before[offsets]


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit polynomial hash of every ``q`` characters in a row, by doubling."""
    if len(points) < q:
        return np.empty(0, np.uint64)
    one = points.astype(np.uint64)
    h, size, factor = one, 1, _K
    for bit in bin(q)[3:]:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % 2**64
        if bit == "1":
            h = h[:-1] * np.uint64(_K) + one[size : size + len(h) - 1]
            size, factor = size + 1, factor * _K % 2**64
    return h


def bloom_slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BLOOM)).view(np.int64)


def edit_budget(m: int, q: int, share: float) -> int:
    """Edits allowed on ``m`` characters: the share asked for, but at least one q-gram must survive them."""
    return max(0, min(int(share * m), (m + 1) // q - 1))


class ItemIndex:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, share: float):
        self.q, self.ids, self.text, self.k = q, [], [], []
        grams, owner, pos = [], [], []
        for item_id, text in items:
            raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            p, _, _ = normal(raw, np.array([0, len(raw)]))
            while len(p) and p[-1] == 32:
                p = p[:-1]
            if len(p) < q:
                continue
            h = gram_hashes(p, q)
            grams.append(h)
            owner.append(np.full(len(h), len(self.ids)))
            pos.append(np.arange(len(h)))
            self.ids.append(item_id)
            self.text.append(p)
            self.k.append(edit_budget(len(p), q, share))
        self.m = np.array([len(t) for t in self.text], np.int64)
        self.budget = np.array(self.k, np.int64)
        self.bound = self.m + 1 - q * (self.budget + 1)
        h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.owner = (np.concatenate(owner) if owner else np.empty(0, np.int64))[order]
        self.pos = (np.concatenate(pos) if pos else np.empty(0, np.int64))[order]
        self.keys, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.bloom = np.zeros(1 << _BLOOM, bool)
        self.bloom[bloom_slot(h)] = True

    def regions(self, points: np.ndarray, edges: np.ndarray):
        """``(row, item, from, to)``: where in ``points`` an item's start may lie, by the q-gram count."""
        h = gram_hashes(points, self.q)
        at = np.flatnonzero(self.bloom[bloom_slot(h)])
        if not len(at) or not len(self.keys):
            return []
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        hit = self.keys[k] == h[at]
        at, k = at[hit], k[hit]
        row = np.searchsorted(edges, at, side="right") - 1
        inside = at + self.q <= edges[row + 1]
        at, k, row = at[inside], k[inside], row[inside]
        n = self.count[k]
        which = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, pos = self.owner[which], self.pos[which]
        row, diagonal = np.repeat(row, n), np.repeat(at, n) - pos
        width = self.budget[item] + 1
        band = (diagonal + self.m[item]) // width  # shifted: a diagonal may begin before the text
        row, item = np.r_[row, row], np.r_[item, item]
        band, pos = np.r_[band, band - 1], np.r_[pos, pos]
        order = np.lexsort((pos, band, item, row))
        row, item, band, pos = row[order], item[order], band[order], pos[order]
        if not len(row):
            return []
        group = np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])]
        fresh = group | np.r_[True, pos[1:] != pos[:-1]]
        begin = np.flatnonzero(group)
        shared = np.add.reduceat(fresh.astype(np.int64), begin)
        good = begin[shared >= self.bound[item[begin]]]
        out: list[list[int]] = []
        for r, i, b in zip(row[good].tolist(), item[good].tolist(), band[good].tolist(), strict=True):
            w = int(self.budget[i]) + 1
            lo = b * w - int(self.m[i])
            hi = lo + 2 * w
            if out and out[-1][:2] == [r, i] and lo <= out[-1][3]:
                out[-1][3] = hi
            else:
                out.append([r, i, lo, hi])
        return out


def align(item: np.ndarray, text: np.ndarray, lo: int, hi: int, k: int):
    """Best place of the whole item in ``text`` with its start diagonal in ``[lo - k, hi + k]``: ``(edits, from, to)``
    or None above ``k`` edits. Each step holds one row of the band."""
    m, base = len(item), lo - k
    width = hi + k - base + 1
    pad = np.full(m + width + 1, np.uint32(0xFFFFFFFF))
    a, b = max(0, base), min(len(text), base + m + width)
    if b > a:
        pad[a - base : b - base] = text[a:b]
    diagonals = np.arange(width)
    inside = (diagonals + base >= 0) & (diagonals + base <= len(text))
    big = m + k + 1
    # row i, diagonal d: edits of item[:i] ending at text position base + i + d; starting anywhere is free
    cost = np.where(inside, 0, big)
    origin = diagonals + base
    up, up_origin = np.full(width, big), np.zeros(width, np.int64)
    for i in range(m):
        up[-1] = big
        end = diagonals + (base + i + 1)
        sub = np.where((end >= 1) & (end <= len(text)), cost + (pad[i : i + width] != item[i]), big)
        up[:-1], up_origin[:-1] = cost[1:], origin[1:]
        up += 1
        best = np.minimum(sub, up)
        src = np.where(sub <= up, origin, up_origin)
        best[(end < 0) | (end > len(text))] = big
        run = np.minimum.accumulate(best - diagonals)
        new = run + diagonals
        took = np.maximum.accumulate(np.where(best - diagonals == run, diagonals, 0))
        cost, origin = np.minimum(new, big), src[took]
    edits = int(cost.min())
    if edits > k:
        return None
    d = int(np.argmin(cost))
    return edits, int(origin[d]), d + base + m


def find_leaks(index: ItemIndex, points: np.ndarray, edges: np.ndarray):
    """``(row, item, from, to, edits)`` over normalised texts."""
    found = []
    for row, i, lo, hi in index.regions(points, edges):
        a, b = int(edges[row]), int(edges[row + 1])
        text, item, k = points[a:b], index.text[i], index.k[i]
        near = max(0, lo - a)
        same = text[near : max(0, hi - a) + len(item)].tobytes().find(item.tobytes())
        if same >= 0 and same % 4 == 0:
            found.append((row, i, a + near + same // 4, a + near + same // 4 + len(item), 0))
            continue
        hit = align(item, text, lo - a, hi - a, k)
        if hit:
            found.append((row, i, a + hit[1], a + hit[2], hit[0]))
    return found


def _scan(items: list[tuple[int | None, str]], q: int, share: float, keyed: bool = False):
    schema = _SCHEMA.append(pa.field("text_key", pa.int64())) if keyed else _SCHEMA
    cache: list[ItemIndex] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(ItemIndex(items, q, share))
        index = cache[0]
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            keys = [(k,) for k in batch.column(2).to_pylist()] if keyed else [()] * len(ids)
            rows = []
            for a, b in chunks(offsets, 1 << 20):
                part = offsets[a : b + 1]
                raw, raw_edges = code_points(data[part[0] : part[-1]], part - part[0])
                points, at, edges = normal(raw, raw_edges)
                for row, i, x, y, edits in find_leaks(index, points, edges):
                    start, end = int(at[x] - raw_edges[row]), int(at[y - 1] + 1 - raw_edges[row])
                    rows.append((ids[a + row], index.ids[i], start, end, edits, index.k[i], *keys[a + row]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                )

    return run


def text_key(text: str | Column) -> Column:
    """Tells rows apart that share an id or have none."""
    return F.xxhash64(text_or_empty(text))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = 8,
    share: float = 0.1,
    block_chars: int = 1 << 20,
    keyed: bool = False,
) -> DataFrame:
    """``(doc_id, item_id, start, end, edits, budget)``: places (code points, end exclusive) where a whole benchmark
    item occurs with at most ``share`` of its characters edited. With ``keyed``, also ``text_key``: see
    :func:`text_key`."""
    items = (
        benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))
        .where(F.length("t") >= q)
        .distinct()
    )
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if keyed:
        d = d.withColumn("text_key", text_key("text"))
    kind = f"{KIND}, text_key long" if keyed else KIND
    out = None
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()
        part = d.mapInArrow(_scan([(r["i"], r["t"]) for r in block], q, share, keyed), kind)
        out = part if out is None else out.union(part)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Ids of documents with a leak, each once."""
    return leaks(docs, benchmark, id_col, **how).select(F.col("doc_id").alias(id_col)).distinct()


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id and text are in ``found``, the keyed leaks; null ids are ordinary ids."""
    gone = found.select(F.col("doc_id").alias("__dc_id"), F.col("text_key").alias("__dc_t"))
    same = docs[id_col].cast("long").eqNullSafe(gone["__dc_id"]) & (text_key(docs[text_col]) == gone["__dc_t"])
    return docs.join(gone, same, "left_anti")
