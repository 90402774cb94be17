"""Toxicity scores by non-negative positive-unlabelled learning.

Training takes confirmed toxic texts (P) and texts without regard to their labels (U), of which a share ``prior`` is
toxic too. For a classifier ``g`` with logistic loss ``l`` the risk is

    prior * E_P l(g) + max(0, E_U l(-g) - prior * E_P l(-g)),

where the second term, the risk on clean texts, is kept from going below zero: when a batch takes it there, the step
goes the other way. The classifiers are linear, trained by numpy with Adam on different draws of the sample, and their
mean is the score. Features are hashes of a text's distinct words, of their first three to six bytes and of their last
four, each weighted by the log ratio of its shares in P and U; those whose shares differ by less than ``SIGMA``
standard errors are left out, so a long text does not gather noise.

The sample is bounded by two parameters: the ``n_toxic`` and ``n_unlabelled`` distinct texts of smallest hash. Only
their features reach the driver. ``prior`` is the share of toxic rows among the labelled training rows, or given.

Defined cases: a null or empty text has no features and scores the mean of the biases; rows without an id are held
out; without one confirmed toxic training text every score is 0; of rows that share an id, a label counts for each;
repeated rows score alike; extra columns are not read; an empty table gives an empty result. Texts are read whole;
memory in a task follows the longest text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textbytes import LOWER, chunks, mix64, running_hashes, utf8

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sample bounds, hash bits of the feature table, what a feature must show, and the training schedule.
N_TOXIC, N_UNLABELLED, BITS, SIGMA, SUPPORT = 1500, 6000, 20, 6.0, 0.003
LEAST_RATIO, MODELS, STEPS, RATE, DECAY = 0.7, 3, 150, 0.05, 1e-3
PREFIXES, SUFFIX = (3, 4, 5, 6), 4
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of every word, prefix and suffix of the texts, with repeats. Words are runs of letters and
    of bytes beyond ASCII; A-Z count as a-z."""
    none = np.empty(0, np.int64)
    if not len(data):
        return none, none
    data = LOWER[data]
    solid, n = _LETTER[data], len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    ends[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    running, inverse = running_hashes(data)
    rows, out = [row], [_bucket(running[end] - running[start], inverse[start], 0)]
    for k in PREFIXES:
        long = end - start > k
        a = start[long]
        rows.append(row[long])
        out.append(_bucket(running[a + k] - running[a], inverse[a], k))
    long = end - start > SUFFIX
    b = end[long]
    rows.append(row[long])
    out.append(_bucket(running[b] - running[b - SUFFIX], inverse[b - SUFFIX], 99))
    return np.concatenate(rows), np.concatenate(out)


def _bucket(span: np.ndarray, inverse: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(span * inverse + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, sorted by row."""
    key = np.unique((row.astype(np.int64) << BITS) | feature)
    return key >> BITS, key & ((1 << BITS) - 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(kind, text)`` to ``(kind, distinct features)``."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets):
            part = offsets[a : b + 1]
            row, feature = distinct(*features(data[part[0] : part[-1]], part - part[0]))
            ends = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["toxic", "features"])


class Model:
    """Sparse weights of all classifiers: ``slot`` maps a feature to its row of ``weights`` (the last row is zero)."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.chosen, self.weights, self.bias = chosen, weights, bias

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        slot = np.full(1 << BITS, -1, np.int32)
        slot[self.chosen] = np.arange(len(self.chosen))
        row, feature = features(data, offsets)
        at = slot[feature]
        known = at >= 0
        row, at = distinct(row[known], at[known])
        z = np.stack([np.bincount(row, w[at], minlength=n) for w in self.weights.T]) + self.bias[:, None]
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).mean(axis=0)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def weighted(pos: list[np.ndarray], unl: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features whose shares in P and U differ clearly, and their log ratios."""
    size = 1 << BITS
    p = np.bincount(np.concatenate(pos), minlength=size).astype(float)
    u = np.bincount(np.concatenate(unl), minlength=size).astype(float)
    n, m = len(pos), len(unl)
    a, b = (p + 0.5) / (n + 1), (u + 0.5) / (m + 1)
    pooled = (p + u + 0.5) / (n + m + 1)
    error = np.sqrt(pooled * (1 - np.minimum(pooled, 0.999)) * (1 / n + 1 / m))
    ratio = np.log(a / b)
    chosen = np.flatnonzero((np.abs(a - b) > SIGMA * error) & (np.abs(ratio) >= LEAST_RATIO) & (p + u >= max(5, SUPPORT * n)))
    return chosen, ratio[chosen]


def nnpu(pos: list[np.ndarray], unl: list[np.ndarray], ratio: np.ndarray, prior: float):
    """Weights and bias of one linear classifier; texts are arrays of feature numbers below ``len(ratio)``."""
    w, b = np.zeros(len(ratio)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def flat(texts):
        row = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        return row, np.concatenate(texts) if texts else np.empty(0, np.int64)

    def push(row, col, g):
        """Gradient of a batch: of the weights, and of the bias."""
        out = np.bincount(col, g[row] * ratio[col], minlength=len(w))
        return np.append(out, g.sum())

    (pr, pc), (ur, uc) = flat(pos), flat(unl)
    for t in range(1, STEPS + 1):
        zp = np.bincount(pr, (w * ratio)[pc], minlength=len(pos)) + b
        zu = np.bincount(ur, (w * ratio)[uc], minlength=len(unl)) + b
        # l(z) = log(1 + exp(-z)); l'(z) = -sigmoid(-z)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        clean_part = push(ur, uc, _sigmoid(zu) / len(unl)) - prior * push(pr, pc, _sigmoid(zp) / len(pos))
        grad = prior * push(pr, pc, -_sigmoid(-zp) / len(pos)) + clean_part if clean >= 0 else -clean_part
        grad[:-1] += DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w * ratio, b


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, models: int = MODELS, seed: int = 13) -> Model:
    chosen, ratio = weighted(pos, unl)
    slot = np.full(1 << BITS, -1, np.int64)
    slot[chosen] = np.arange(len(chosen))
    pos, unl = ([s[s >= 0] for s in (slot[x] for x in texts)] for texts in (pos, unl))
    found = []
    for k in range(models):
        rng = np.random.default_rng((seed, k))
        draw = [[texts[i] for i in rng.integers(0, len(texts), len(texts))] for texts in (pos, unl)]
        found.append(nnpu(draw[0], draw[1], ratio, prior))
    return Model(chosen, np.stack([w for w, _ in found], axis=1), np.array([b for _, b in found]))


def _fold(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5, F.lit(0))


def sample(docs: DataFrame, labels: DataFrame, n_toxic: int, n_unlabelled: int):
    """Features of the smallest distinct texts by hash: confirmed toxic ones, and any; and the share of toxic rows
    among the labelled training rows (None without such rows)."""
    training = docs.where("fold <> 0").select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    known = labels.where("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marked = written(training.select("doc_id", "h").join(known, "doc_id").select("h", "toxic"), "labelled-hashes")
    prior = marked.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    chosen = [
        side.select("h").distinct().orderBy("h").limit(n).select("h", F.lit(t).alias("toxic"))
        for side, n, t in ((marked.where("toxic = 1"), n_toxic, 1), (training, n_unlabelled, 0))
    ]
    # at most n_toxic + n_unlabelled rows of two numbers
    wanted = F.broadcast(written(chosen[0].union(chosen[1]), "chosen-hashes"))
    texts = training.join(wanted, "h").groupBy("h", "toxic").agg(F.first("text").alias("text")).select("toxic", "text")
    rows = texts.mapInArrow(_sampled, "toxic int, features array<int>").toArrow()
    toxic = np.asarray(rows.column("toxic"))
    lists = [np.asarray(x.values, dtype=np.int64) for x in rows.column("features")]
    order = sorted(range(len(lists)), key=lambda i: (len(lists[i]), lists[i].tobytes()))
    return [lists[i] for i in order if toxic[i] == 1], [lists[i] for i in order if toxic[i] == 0], prior


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_toxic: int = N_TOXIC,
    n_unlabelled: int = N_UNLABELLED,
    prior: float | None = None,
) -> DataFrame:
    """One row per document: ``(doc_id, held_out, score, predicted)``. Labels are learnt from rows whose
    ``crc32(doc_id as text) mod 5`` is not 0; the others are held out."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _fold(id_col).alias("fold"))
    pos, unl, share = sample(d, labels, n_toxic, n_unlabelled)
    prior = min(max(share if prior is None else prior, 0.001), 0.9) if pos else 0.0
    model = fit(pos, unl, prior) if pos else None

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                part = offsets[a : b + 1]
                s = model.score(data[part[0] : part[-1]], part - part[0]) if model else np.zeros(b - a)
                head = [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a)]
                cols = [*head, pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted"])

    out = "doc_id long, held_out boolean, score double, predicted int"
    return d.select("doc_id", "text", (F.col("fold") == 0).alias("held_out")).mapInArrow(scored, out)
