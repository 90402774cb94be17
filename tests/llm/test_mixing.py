import numpy as np
import pytest

from telemsg.llm.mixing import mix, mixed_texts, sainte_lague

from .helpers import WORD, empty_docs, odd_docs


def one_by_one(votes, seats, caps):
    out = [0] * len(votes)
    for _ in range(min(seats, sum(c for v, c in zip(votes, caps) if v))):
        q = [v / (2 * a + 1) if a < c else -1 for v, a, c in zip(votes, out, caps)]
        out[int(np.argmax(q))] += 1
    return out


@pytest.mark.parametrize("seed", range(20))
def test_apportionment(seed):
    rng = np.random.default_rng(seed)
    votes = rng.integers(0, 50, rng.integers(1, 12)).astype(float)
    seats, caps = int(rng.integers(0, 60)), rng.integers(0, 20, len(votes))
    assert sainte_lague(votes, seats, caps).tolist() == one_by_one(votes, seats, caps)


def targets(sizes, share=1.5, limit=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, rest, out = share * sum(sizes.values()), set(names), {}
    while rest:
        total = sum(weight[s] for s in rest)
        over = {s for s in rest if left * weight[s] / total >= limit * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in rest}
        for s in over:
            out[s] = limit * sizes[s]
        left, rest = left - sum(out[s] for s in over), rest - over
    return out


def test_mix(spark):
    docs = odd_docs(spark)
    rows = mix(docs, tokens_per_shard=500).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and {r.source_size for r in rows if r.source == s} == {sizes[s]}
        assert abs(taken[s] - want[s]) <= 24, (s, taken[s], want[s])
    again = mix(docs.repartition(5), tokens_per_shard=500).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mix(empty_docs(spark)).count() == 0


def test_texts_have_the_words_taken(spark):
    docs = odd_docs(spark, repeats=False, null_id=False)
    plan = mix(docs, tokens_per_shard=500)
    want = {r.doc_id: r.taken for r in plan.collect()}
    got = {}
    for r in mixed_texts(docs, plan).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert {k: v for k, v in want.items() if v} == {k: v for k, v in got.items() if v}
