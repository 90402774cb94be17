import random

from telemsg.llm.components import components
from telemsg.llm.minhash_dedup import near_duplicates

from .helpers import empty_docs, odd_docs, sentence, words


def sets(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, num=85):
    s = {i: sets(t) for i, t in rows}
    label = {i: i for i in s}
    changed = True
    while changed:
        changed = False
        for a in s:
            for b in s:
                c = len(s[a] & s[b])
                if a < b and c and 100 * c >= num * (len(s[a]) + len(s[b]) - c) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(s[i]), label[i], label[i] == i) for i in s}


def test_against_brute_force(spark):
    docs = odd_docs(spark)
    rng = random.Random(8)
    extra = []
    for k in range(12):  # chains: each copy drifts from the one before
        w = sentence(rng, 120).split()
        for j in range(5):
            extra.append((1000 + 10 * k + j, " ".join(w)))
            w[rng.randrange(len(w))] = f"d{k}x{j}"
            if k % 2:
                w[rng.randrange(len(w))] = f"e{k}x{j}"
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    want = brute(rows.items())
    got = near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]
    assert near_duplicates(empty_docs(spark)).count() == 0


def test_mixed_buckets_lose_no_link(spark):
    """Two families that share much: buckets hold several components, and all true links are found."""
    rng = random.Random(5)
    base = sentence(rng, 200).split()
    rows = []
    for f in range(6):
        w = list(base)
        for p in rng.sample(range(200), 6):
            w[p] = f"fam{f}"
        for j in range(8):
            v = list(w)
            v[rng.randrange(200)] = f"own{f}x{j}"
            rows.append((f * 100 + j, " ".join(v)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 100), (7, 7), (500, 400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100, 400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
