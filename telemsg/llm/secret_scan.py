"""Secret scans: fixed patterns, and character Markov models for what they miss.

Two first-order models of characters, one of random strings and one of ordinary identifiers, are compared by their
log-likelihood ratio on every token of eight or more characters that no pattern covers; what a pattern covers is cut
out, and what stays on either side is judged by itself. A token is a row of pieces between ``/ + _ -``; those runs of
pieces are reported whose summed ratio is evidence enough and whose mean is high, so a short token needs a high mean,
a long one need not hold digits or letters, and a secret in a path is not judged by the words around it. Strings of
digits alone are judged too, but where a corpus is full of numbers they look ordinary. The models are trained
from labelled samples: values that the patterns find in the corpus and seeded random strings stand for the first, all
other tokens of eight or more characters of the corpus for the second. The counts are two tables of characters by
characters, summed over all documents by a map-side aggregation.

Defined cases: a null text is empty and has no spans; very long texts are scanned whole; repeated rows are scanned
alike; extra columns are not read; an empty table leaves the models with the seeded strings alone. Spans are code
points, end exclusive; on equal starts the order is assign, access, hex, markov.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import chunks, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the task: kind, pattern, group measured, least length.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = string.ascii_letters + string.digits + "+/_=.-"
_K = len(ALPHABET) + 1  # the last state is "outside a token"
_CODE = np.full(256, _K - 1, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
_INNER = np.zeros(256, bool)  # a token's characters but for padding
_INNER[[ord(_c) for _c in ALPHABET if _c not in "=."]] = True
_ALNUM = _INNER.copy()
_ALNUM[[ord(_c) for _c in "+/_-"]] = False
_PIECE = re.compile(rb"[A-Za-z0-9]+")
_PADDING = re.compile(rb"=*")
#: Characters of the shortest token judged.
SHORTEST = 8
#: Share of pairs in ordinary tokens that follow no habit.
ANY = 0.02


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping matches of each pattern that are long enough."""
    out = []
    for kind, pattern, group, least in PATTERNS:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pair_counts(data: np.ndarray, least: int = 8) -> np.ndarray:
    """Character pairs within tokens of ``least`` or more characters, as a table ``_K x _K``."""
    code = np.r_[_K - 1, _CODE[data], _K - 1]
    solid = code != _K - 1
    begin = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    end = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
    long = end - begin >= least
    inside = np.zeros(len(code) + 1, np.int64)
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, end[long], -1)
    at = np.flatnonzero(np.cumsum(inside)[: len(code)])
    at = at[solid[at - 1]]
    return np.bincount(code[at - 1] * _K + code[at], minlength=_K * _K)


def seeded_strings(n: int, seed: int = 4242) -> list[str]:
    """Random strings in the usual alphabets: hexadecimal, base 36, base 62 and base 64."""
    rng = random.Random(seed)
    alphabets = [
        "0123456789abcdef", "0123456789ABCDEF", string.ascii_lowercase + string.digits,
        string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
    ]
    return ["".join(rng.choices(alphabets[i % 5], k=rng.randint(20, 64))) for i in range(n)]


_COUNTS = pa.schema([("label", pa.int32()), ("pair", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, _K * _K), np.int64)
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for a, b in chunks(offsets):
            part = data[offsets[a] : offsets[b]].copy()
            found = []
            for i in range(a, b):  # matches are ASCII: cut them out by bytes
                raw = part[offsets[i] - offsets[a] : offsets[i + 1] - offsets[a]].tobytes().decode("latin-1")
                for kind, x, y in base_spans(raw):
                    value = raw[x:y] if kind != "assign" else PATTERNS[0][1].match(raw, x).group(2)
                    found.append(value)
                    part[offsets[i] - offsets[a] + x : offsets[i] - offsets[a] + y] = 32
            total[0] += pair_counts(part)
            total[1] += pair_counts(np.frombuffer(" ".join(found).encode("latin-1"), np.uint8))
    label, pair = np.nonzero(total)
    if len(label):
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(total[label, pair])], schema=_COUNTS
        )


class Markov:
    """Log-likelihood ratio of random strings against identifiers, per pair of characters."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(2, _K, _K)[:, :-1, :-1].astype(float)
        single = c.sum(axis=1) + 1.0
        single /= single.sum(axis=1, keepdims=True)
        # pairs are smoothed towards single characters: after a rare one, the next is judged by itself
        weight = 5.0
        p = np.log((c + weight * single[:, None, :]) / (c.sum(axis=2, keepdims=True) + weight))
        # a rare pair alone proves nothing: some pairs of ordinary tokens follow no habit
        self.ratio = p[1] - np.logaddexp(p[0] + np.log(1 - ANY), np.log(ANY / (_K - 1)))

    def tokens(self, data: np.ndarray, total: float):
        """Tokens whose pairs can sum up to ``total`` nats, as ``(start, end)``, and the running sum of all pairs:
        the pairs of ``data[a:b]`` sum up to ``sums[b - 1] - sums[a]``."""
        code, solid = _CODE[data], _INNER[data]
        pairs = np.zeros(max(0, len(data) - 1))
        inside = _ALNUM[data]  # what separates pieces tells nothing
        at = np.flatnonzero(inside[:-1] & inside[1:])
        pairs[at] = self.ratio[code[at], code[at + 1]]
        sums = np.r_[0.0, np.cumsum(pairs)]
        most = np.r_[0.0, np.cumsum(np.maximum(pairs, 0.0))]
        edge = np.flatnonzero(np.diff(np.r_[False, solid, False]))
        begin, end = edge[::2], edge[1::2]
        may = (end - begin >= SHORTEST) & (most[end - 1] - most[begin] >= total - 1e-6)
        return list(zip(begin[may].tolist(), end[may].tolist(), strict=True)), sums


def random_runs(pieces: list[tuple[int, int]], sums: np.ndarray, least: float, total: float) -> list[tuple[int, int]]:
    """Of a token's pieces, the runs whose pairs sum up to ``total`` or more with a mean of ``least`` or more: the
    highest above ``least`` a pair first start to end, then on behind it."""
    out, k = [], 0
    over = [(float(sums[a]) - least * a, float(sums[b - 1]) - least * (b - 1)) for a, b in pieces]

    def enough(a: int, b: int) -> bool:
        return b - a >= SHORTEST and sums[b - 1] - sums[a] >= total

    while k < len(pieces):
        start, top, good, j = over[k][0], 0.0, None, k
        while j < len(pieces) and (j == k or over[j][0] > start) and top - (over[j][1] - start) < total:
            v = over[j][1] - start
            top = max(top, v)
            if v >= 0 and (good is None or v > good[0]) and enough(pieces[k][0], pieces[j][1]):
                good = (v, j)
            j += 1
        if good:
            out.append((pieces[k][0], pieces[good[1]][1]))
            k = good[1] + 1
        else:
            k = max(j, k + 1)
    if not out and pieces and over[-1][1] >= over[0][0] and enough(pieces[0][0], pieces[-1][1]):
        out = [(pieces[0][0], pieces[-1][1])]
    return out


def train(docs: DataFrame, text_col: str = "text", n_random: int = 5000) -> Markov:
    """The models from all of ``docs`` and ``n_random`` seeded strings; at most 2 * 69 * 69 rows come back."""
    rows = docs.select(F.col(text_col)).mapInArrow(_count, "label int, pair int, n long")
    counts = np.zeros((2, _K * _K))
    for r in rows.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        counts[r["label"], r["pair"]] = r["n"]
    seeded = pair_counts(np.frombuffer(" ".join(seeded_strings(n_random)).encode(), np.uint8))
    scale = max(1.0, counts[1].sum() / max(1, seeded.sum()))  # half of what random strings look like, at any size
    counts[1] += seeded * scale
    return Markov(counts)


def all_spans(text: str, model: Markov, least: float, total: float = 13.3) -> list[tuple[str, int, int]]:
    out = base_spans(text)
    data = np.frombuffer(text.encode("ascii", "replace"), np.uint8).copy()  # one byte a code point
    for _, a, b in out:
        data[a:b] = 32
    tokens, sums = model.tokens(data, total)
    raw = data.tobytes() if tokens else b""
    for a, b in tokens:
        pieces = [m.span() for m in _PIECE.finditer(raw, a, b)]
        for x, y in random_runs(pieces, sums, least, total):
            out.append(("markov", x, _PADDING.match(raw, y).end() if y == b else y))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"


def _find(model: Markov, least: float, total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                spans = all_spans(text.as_py() or "", model, least, total)
                base = [s for s in spans if s[0] != "markov"]
                n = [sum(s[0] == k for s in spans) for k in KINDS]
                rows.append((doc_id, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = list(zip(*rows, strict=True)) or [()] * 7
            names = [x.split()[0] for x in _OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: Markov | None = None,
    least: float = 0.7,
    total: float = 13.3,
) -> DataFrame:
    """One row per document: counts by kind, a digest of the pattern spans, and all spans as ``kind:start:end``.
    ``least`` is the mean log-likelihood ratio (nats a pair) and ``total`` its sum from which a run of pieces counts as
    random; 13.3 is what twenty characters of the least mean have, and odds of 600,000 to one."""
    model = model or train(docs, text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _find(model, least, total), _OUT
    )
