"""Positive-unlabelled toxicity scores: the risk, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from .helpers import empty_docs, odd_docs, sentence

INSULTS = ["vilefool", "grimscum", "lowknave", "dirtrat", "hagstone"]


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = sentence(rng, rng.randint(20, 120)).split()
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + rng.choice(["", "s", "er"]))
        docs.append((i, " ".join(w), "s"))
        if rng.random() < 0.8:
            labels.append((i, 0, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    from telemsg.llm.toxicity import toxicity

    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, held_out string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity(d, lab).collect()}
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    held = [(got[i].predicted, t) for i, t in truth.items() if got[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([a for a, b in held if b]) > 0.9
    # another order and other partitions give the same scores, and held-out labels are not read
    shuffled = spark.createDataFrame(docs[::-1], "doc_id long, text string, z string").repartition(7)
    flipped = spark.createDataFrame([(i, q, 1 - t if got[i].held_out else t) for i, q, t in labels], lab.schema)
    again = {r.doc_id: r.score for r in toxicity(shuffled, flipped).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())


def test_risk_stays_non_negative():
    from telemsg.llm.toxicity import nnpu

    rng = np.random.default_rng(0)
    pos = [np.array([0, *rng.integers(2, 40, 3)]) for _ in range(60)]
    unl = [np.array([0 if rng.random() < 0.1 else 1, *rng.integers(2, 40, 3)]) for _ in range(600)]
    w, b = nnpu(pos, unl, np.ones(40), 0.15)
    z = lambda texts: np.array([w[x].sum() + b for x in texts])
    clean = np.logaddexp(0, z(unl)).mean() - 0.15 * np.logaddexp(0, z(pos)).mean()
    assert clean > -0.02 and (z(pos) > 0).mean() > 0.95 and np.isfinite(w).all()


def test_features_follow_words_only():
    from telemsg.llm.textbytes import utf8
    from telemsg.llm.toxicity import distinct, features
    import pyarrow as pa

    def of(text):
        return set(distinct(*features(*utf8(pa.array(["x", text]))))[1].tolist())

    assert of("Some WORDS here") == of("here, words! some; some")
    assert of("") == of(None) == of(" \n 123") != of("y")
    assert of("abcdefgh") & of("abcdezzz") and not of("abc") & of("abd") - of("x")
    whole = features(*utf8(pa.array(["one two", "two é"])))
    assert set(whole[0].tolist()) == {0, 1}


@pytest.mark.parametrize("known", [[], [(100, 0, 0)], [(100, 0, 1), (101, 0, None), (None, 0, 1), (300, 1, 0), (100, 0, 1)]])
def test_odd_rows(spark, known):
    from telemsg.llm.toxicity import toxicity

    lab = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    docs = odd_docs(spark)
    out = toxicity(docs, lab).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 for r in out) and all(r.held_out for r in out if r.doc_id is None)
    if not any(t for _, _, t in known):
        assert {r.score for r in out} == {0.0}
    empty = [r.score for r in out if r.doc_id in (1, 2, 3)]
    assert len(set(empty)) == 1
    assert toxicity(empty_docs(spark), lab).count() == 0
