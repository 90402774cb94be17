"""Words and their 64-bit hashes for many texts at once, as numpy arrays over UTF-8 bytes.

White space of the contracts is ASCII, so words can be cut on bytes. A word's hash is a polynomial over a random
64-bit value for each byte, taken from one running sum over the whole chunk, then mixed: no loop over words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_VALUE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 & ~7 | 5
_POWERS: dict[str, np.ndarray] = {}


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        size = max(n, 1 << 20)
        for key, base in (("p", _BASE), ("q", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and n + 1 offsets into them; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``max_bytes`` of text each, or of one row."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def running_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(running, inverse)``: the bytes from a to b hash to ``mix64((running[b] - running[a]) * inverse[a])``."""
    power, inverse = _powers(len(data))
    running = np.empty(len(data) + 1, dtype=np.uint64)
    running[0] = 0
    np.cumsum(_VALUE[data] * power, dtype=np.uint64, out=running[1:])
    return running, inverse


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """``(start, end, row, hash)`` of every word, in order. With ``lower``, A-Z count as a-z."""
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    if lower:
        data = LOWER[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    solid = ~IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    running, inverse = running_hashes(data)
    h = mix64((running[end] - running[start]) * inverse[start])
    return start, end, np.searchsorted(offsets, start, side="right") - 1, h


def shingles(row: np.ndarray, h: np.ndarray, n_rows: int, width: int = 5):
    """Distinct ``width``-word shingles of each row as ``(row, hash)`` sorted by both. A row with fewer words has
    its whole sequence as its one shingle; one without words has none."""
    count = np.bincount(row, minlength=n_rows)
    m = len(h) - width + 1
    k = np.uint64(0xD6E8FEB86659FD93)
    if m > 0:
        g = h[:m]
        for j in range(1, width):
            g = g * k + h[j : m + j]
        ok = row[:m] == row[width - 1 :]
        rows, grams = row[:m][ok], mix64(g[ok])
    else:
        rows, grams = np.empty(0, np.int64), np.empty(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.searchsorted(row, short)
        g = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            more = count[short] > j
            at = np.minimum(first + j, len(h) - 1)
            g = np.where(more, g * k + h[at] + np.uint64(j + 1), g)
        rows, grams = np.concatenate([rows, short]), np.concatenate([grams, mix64(g ^ np.uint64(0x5A5A5A5A))])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[new], grams[new]
