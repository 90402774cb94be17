"""Language-model scoring with bigrams held in Elias-Fano tries.

Documents are encoded in batches: a batch has its own dictionary of word hashes and its tokens as numbers in it.
A batch sends each distinct word and each distinct bigram once, with its count in the training documents, to a shard
chosen by the hash of the context; so a frequent word or word pair is one entry a batch, however often it occurs.
Contexts with a large share of all tokens - at most ``1 / HOT`` words can have it - are spread over all shards by the
hash of the whole bigram. A shard adds up the counts of all batches, builds its trie - monotone pointers, successors
relative to their context, probabilities quantised in steps of 0.4 % - maps the levels from a file, looks up what the
batches asked for and sends the codes back. A batch then scores its documents.

The unigram probability is ``(c + 0.5) / (N + 0.5 (V + 1))``. The bigram one is smoothed towards it with weight
``mu / (c(context) + mu)``, the context's count being exact and the bigram's the trie's. The first context of a text is
a start mark. Words are lower-cased in A-Z and known by 64-bit hashes, as successors in the trie by 40 bits.

Defined cases: a null or empty text is one token, the end; a null id has the remainder 0 and is trained on; repeated
rows count as often as they occur; extra columns are not read; an empty table gives an empty result. A batch is a few
megabytes of text or one text: memory in a task follows the longest single text.
"""

from __future__ import annotations

import os
import sys
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, written
from .elias_fano import Trie
from .textbytes import chunks, mix64, utf8, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END, START = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0x57A7757A7757A771)
WORD_BITS = 40
STEP = np.log(1.004)
#: Codes are 16 bits; the largest stands for 1.004 ** 65534 occurrences, beyond any count.

HOT = 0.0005

_ENCODED = (
    "batch long, ids array<bigint>, held binary, sizes binary, tokens binary, dict binary, n_train long, n_docs long, n_tokens long, "
    "frequent array<struct<word:bigint,n:bigint>>"
)
_FREQUENT = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))


def squeeze(a: np.ndarray) -> bytes:
    """An array's bytes, compressed."""
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(data: bytes, kind) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), kind)


def planes(a: np.ndarray) -> np.ndarray:
    """Numbers below 2^32 with all their first bytes before all their second ones, and so on: high bytes are
    mostly zero and compress to nothing."""
    return np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def unplanes(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _encode(max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        ids, sizes, hashes, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal nth, ids, sizes, hashes, size
            stream = np.concatenate(hashes)
            names, tokens, n = np.unique(stream, return_inverse=True, return_counts=True)
            held = np.array([held_out(i) for i in ids], np.uint8)
            counts = np.concatenate(sizes).astype(np.int64)
            n_train, n_docs = int(counts[held == 0].sum()), int((held == 0).sum())
            rank = np.argsort(-n, kind="stable")  # frequent words get small numbers
            number = np.empty(len(names), np.int64)
            number[rank] = np.arange(len(names))
            often = np.flatnonzero(n >= HOT / 2 * len(stream))
            row = {
                "batch": [(part << 32) + nth],
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([squeeze(held)], pa.binary()),
                "sizes": pa.array([squeeze(planes(counts))], pa.binary()),
                "tokens": pa.array([squeeze(planes(number[tokens]))], pa.binary()),
                "dict": pa.array([names[rank].tobytes()], pa.binary()),
                "n_train": [n_train],
                "n_docs": [n_docs],
                "n_tokens": [len(stream)],
                "frequent": pa.array(
                    [
                        [{"word": int(w), "n": int(c)} for w, c in zip(names.view(np.int64)[often], n[often], strict=True)]
                        + [{"word": int(START.view(np.int64)), "n": len(ids)}]
                    ],
                    _FREQUENT,
                ),
            }
            nth += 1
            ids, sizes, hashes, size = [], [], [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets):
                cut = offsets[a : b + 1]
                _, _, row, h = words(data[cut[0] : cut[-1]], cut - cut[0])
                n = np.bincount(row, minlength=b - a)
                hashes.append(np.insert(h, np.cumsum(n), END))  # every text ends in the end mark
                sizes.append(n + 1)
                ids += batch.column(0).slice(a, b - a).to_pylist()
                size += int(cut[-1] - cut[0])
                if size >= max_bytes:
                    yield flush()
        if ids:
            yield flush()

    return run


class Batch:
    """One encoded batch, and its distinct bigrams in the order of the hashes of context and word."""

    def __init__(self, row, hot: np.ndarray):
        self.ids = row["ids"]
        self.held = expand(row["held"], np.uint8).astype(bool)
        self.sizes = unplanes(expand(row["sizes"], np.uint8))
        self.first = np.cumsum(self.sizes) - self.sizes
        names = np.r_[np.frombuffer(row["dict"], np.uint64), START]
        order = np.argsort(names)
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        self.names, self.start = names[order], place[-1]
        self.tokens = place[unplanes(expand(row["tokens"], np.uint8))]
        self.train = ~np.repeat(self.held, self.sizes)  # by token
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.first] = self.start
        u = len(names)
        pairs, pair_of = np.unique(before * u + self.tokens, return_inverse=True)
        self.pair_of = pair_of.astype(np.int32)
        self.context, self.word = pairs // u, pairs % u
        at = np.minimum(np.searchsorted(hot, self.names), max(len(hot) - 1, 0))
        is_hot = hot[at] == self.names if len(hot) else np.zeros(u, bool)
        self.hot_number = at
        spread = is_hot[self.context]
        self.cold, self.hot = np.flatnonzero(~spread), np.flatnonzero(spread)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.names))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair_of[self.train], minlength=len(self.context))

    def dealt(self, n: int):
        """For words, bigrams of other contexts and bigrams of hot contexts: their numbers by shard, and the edges."""
        by_word = (mix64(self.names) % np.uint64(n)).astype(np.int64)
        c, w = self.names[self.context[self.hot]], self.names[self.word[self.hot]]
        by_pair = (mix64(c * np.uint64(0x9E3779B97F4A7C15) ^ w) % np.uint64(n)).astype(np.int64)
        out = []
        for shard, numbers in (
            (by_word, np.arange(len(self.names))), (by_word[self.context[self.cold]], self.cold), (by_pair, self.hot),
        ):
            order = np.argsort(shard, kind="stable")
            out.append((numbers[order], np.searchsorted(shard[order], np.arange(n + 1))))
        return out


def short(word: np.ndarray) -> np.ndarray:
    return word >> np.uint64(64 - WORD_BITS)


def pack(word: np.ndarray) -> bytes:
    """Five bytes a word."""
    return np.ascontiguousarray(short(word).view(np.uint8).reshape(-1, 8)[:, : WORD_BITS // 8]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // WORD_BITS, 8), np.uint8)
    out[:, : WORD_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, WORD_BITS // 8)
    return out.view(np.uint64).ravel()


_SENT = (
    "shard int, batch long, names binary, counts binary, runs binary, words binary, pair_counts binary, "
    "hot_contexts binary, hot_words binary, hot_counts binary"
)


def _send(n_shards: int, hot: np.ndarray):
    kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 8
    names = [x.split()[0] for x in _SENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = rows.slice(i, 1).to_pylist()[0]
                b = Batch(row, hot)
                counts, pairs = b.word_counts(), b.pair_counts()
                runs = np.bincount(b.context[b.cold], minlength=len(b.names))
                (words, we), (cold, ce), (spread, he) = b.dealt(n_shards)
                out = []
                for s in range(n_shards):
                    w, c, h = words[we[s] : we[s + 1]], cold[ce[s] : ce[s + 1]], spread[he[s] : he[s + 1]]
                    if not len(w) and not len(h):
                        continue
                    out.append(
                        (
                            s, row["batch"], b.names[w].tobytes(), squeeze(planes(counts[w])), squeeze(planes(runs[w])),
                            pack(b.names[b.word[c]]), squeeze(planes(pairs[c])),
                            squeeze(planes(b.hot_number[b.context[h]])), pack(b.names[b.word[h]]), squeeze(planes(pairs[h])),
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, k) for col, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
                )

    return run


def summed(keys: list[np.ndarray], counts: np.ndarray):
    """Distinct keys (sorted, columns from first to last) and the sum of the counts of each."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], first) if len(first) else np.empty(0, np.int64)
    return [k[first] for k in keys], total


def quantised(count: np.ndarray, total: int) -> np.ndarray:
    """Code of the joint probability ``count / total``: steps of ``STEP`` above that of one occurrence."""
    return (1 + np.rint((np.log(count / total) - np.log(1 / total)) / STEP)).astype(np.uint16)


def counts_of(codes: np.ndarray) -> np.ndarray:
    """Occurrences a code stands for; 0 for code 0."""
    return np.where(codes > 0, np.exp((codes.astype(float) - 1) * STEP), 0.0)


_BACK = "batch long, shard int, counts binary, codes binary, hot_codes binary, n_words long"


def _answer(total: int, hot: np.ndarray):
    def run(sent: pd.DataFrame) -> pd.DataFrame:
        """One shard: adds up all batches, builds its trie and answers each batch in the order it asked."""
        numbers = lambda column: [unplanes(expand(x, np.uint8)) for x in sent[column]]
        names, counts = np.frombuffer(b"".join(sent["names"]), np.uint64), numbers("counts")
        cold, spread = numbers("pair_counts"), numbers("hot_counts")
        (known,), sums = summed([names], np.concatenate(counts))
        context = np.r_[np.repeat(names, np.concatenate(numbers("runs"))), hot[np.concatenate(numbers("hot_contexts"))]]
        word = np.r_[unpack(b"".join(sent["words"])), unpack(b"".join(sent["hot_words"]))]
        (c, w), n = summed([context, word], np.concatenate(cold + spread))
        seen = n > 0
        trie = Trie.build(c[seen], w[seen], quantised(n[seen], total), WORD_BITS)
        fd, path = tempfile.mkstemp(suffix=".trie")
        os.close(fd)
        try:
            trie.save(path)
            codes = Trie.load(path).codes_of(context, word)
        finally:
            os.unlink(path)
        found = sums[np.searchsorted(known, names)]
        cut = lambda a, parts: np.split(a, np.cumsum([len(x) for x in parts])[:-1])
        middle = sum(len(x) for x in cold)
        return pd.DataFrame(
            {
                "batch": sent["batch"].to_numpy(),
                "shard": sent["shard"].to_numpy(),
                "counts": [squeeze(x) for x in cut(found, counts)],
                "codes": [squeeze(x) for x in cut(codes[:middle], cold)],
                "hot_codes": [squeeze(x) for x in cut(codes[middle:], spread)],
                "n_words": [int((sums > 0).sum())] + [0] * (len(sent) - 1),
            }
        )

    return run


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score(n_shards: int, hot: np.ndarray, total: int, n_words: int, n_docs: int, mu: float):
    def run(encoded: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, row in encoded.iterrows():
            b = Batch(row, hot)
            count, code = np.zeros(len(b.names), np.int64), np.zeros(len(b.context), np.uint16)
            (words, we), (cold, ce), (spread, he) = b.dealt(n_shards)
            for s, x, y, z in zip(back["shard"], back["counts"], back["codes"], back["hot_codes"], strict=True):
                count[words[we[s] : we[s + 1]]] = expand(x, np.int64)
                code[cold[ce[s] : ce[s + 1]]] = expand(y, np.uint16)
                code[spread[he[s] : he[s + 1]]] = expand(z, np.uint16)
            single = (count + 0.5) / (total + 0.5 * (n_words + 1))
            before = count.copy()
            before[b.start] = n_docs
            before = before[b.context]
            pair = np.log10((counts_of(code) + mu * single[b.word]) / (before + mu))
            known = np.add.reduceat((count[b.tokens] > 0).astype(np.int64), b.first)
            base = np.add.reduceat(np.log10(single)[b.tokens], b.first)
            score = np.add.reduceat(pair[b.pair_of], b.first)
            rows.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(list(b.ids), "Int64"), "held_out": b.held, "n_tokens": b.sizes,
                        "n_known": known, "train_tokens": total, "base_score": base, "score": score,
                    }
                )
            )
        return pd.concat(rows) if rows else pd.DataFrame(columns=[x.split()[0] for x in _SCORES.split(", ")])

    return run


def lm_score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu: float = 16.0, batch_bytes: int = 6 << 20
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every document; the model is
    learnt from those whose ``crc32(doc_id as text) % 5`` is not 1. Scores are log10 probabilities of the text."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encoded = written(d.mapInArrow(_encode(batch_bytes), _ENCODED), "encoded")
    sums = encoded.agg(F.sum("n_train").alias("t"), F.sum("n_docs").alias("d")).first()
    total, n_docs = sums["t"] or 0, sums["d"] or 0
    frequent = encoded.select(F.explode("frequent").alias("f")).groupBy("f.word").agg(F.sum("f.n").alias("n"))
    tokens = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    hot = frequent.where(F.col("n") >= HOT * tokens).select("word").collect()  # at most 1 / HOT words
    hot = np.sort(np.array([r["word"] for r in hot], np.int64).view(np.uint64))
    width = shuffle_width(spark)
    sent = encoded.mapInArrow(_send(width, hot), _SENT)
    back = written(sent.groupBy("shard").applyInPandas(_answer(max(1, total), hot), _BACK), "answers")
    n_words = back.agg(F.sum("n_words")).first()[0] or 0
    scored = encoded.groupBy("batch").cogroup(back.groupBy("batch"))
    return scored.applyInPandas(_score(width, hot, total, n_words, n_docs, mu), _SCORES)
