import math
import zlib
from collections import Counter

import numpy as np
import pytest

from telemsg.llm.elias_fano import EliasFano, Trie
from telemsg.llm.lm_score import lm_score

from .helpers import empty_docs, odd_docs, words


@pytest.mark.parametrize("n, u", [(0, 10), (1, 1), (3, 100), (1000, 500), (1000, 1 << 63), (5000, 1 << 40)])
def test_elias_fano(n, u):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, u, n, dtype=np.uint64))
    e = EliasFano.build(v, u)
    assert (e.access(np.arange(n)) == v).all()
    q = np.r_[v, rng.integers(0, u, 500, dtype=np.uint64)]
    assert (e.successor(q) == np.searchsorted(v, q)).all()


def test_trie_round_trip(tmp_path):
    rng = np.random.default_rng(4)
    grams = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 3000), rng.zipf(1.4, 3000) % 1000)})
    c, w = (np.array(x, np.uint64) * np.uint64(1 << 30) for x in zip(*grams))
    codes = rng.integers(1, 60000, len(c))
    Trie.build(c, w, codes, 40).save(tmp_path / "t")
    t = Trie.load(str(tmp_path / "t"))
    assert (t.codes_of(c, w) == codes).all()
    known = set(zip(c.tolist(), w.tolist()))
    for a, b in ((c, w + np.uint64(1)), (c[::-1].copy(), w), (c + np.uint64(5), w)):
        hit = np.array([(x, y) in known for x, y in zip(a.tolist(), b.tolist())])
        assert ((t.codes_of(a, b) > 0) == hit).all()


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def test_against_plain_counts(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, [*words(r.text), None]) for r in docs.collect()]
    uni, bi, n_docs = Counter(), Counter(), 0
    for i, w in rows:
        if not held(i):
            uni.update(w)
            bi.update(zip(["<s>", *w], w))
            n_docs += 1
    n, v, mu = sum(uni.values()), len(uni), 16.0
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    got = lm_score(docs, mu=mu, batch_bytes=4000).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for i, w in rows:
        r = by[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(uni[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10(p(x)) for x in w), abs=1e-7)
        c = lambda a: n_docs if a == "<s>" else uni[a]
        score = sum(math.log10((bi[a, x] + mu * p(x)) / (c(a) + mu)) for a, x in zip(["<s>", *w], w))
        assert r.score == pytest.approx(score, abs=0.001 * len(w))
    assert lm_score(empty_docs(spark)).count() == 0
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
