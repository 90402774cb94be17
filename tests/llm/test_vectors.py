"""Vector operators against plain Lloyd rounds, and the bounds they prune by."""

import hashlib

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string, code string, cluster int, distance long, l int"


def lloyd(x, start, rounds):
    """Exact integer Lloyd rounds: (assignment, squared distances, entries)."""
    e = [list(map(int, r)) for r in start]

    def near():
        d = [[sum((a - b) ** 2 for a, b in zip(r, c, strict=True)) for c in e] for r in x.tolist()]
        return [min(range(len(e)), key=lambda k: (row[k], k)) for row in d], d

    for _ in range(rounds):
        to, _ = near()
        for k in range(len(e)):
            mine = [r for r, t in zip(x.tolist(), to, strict=True) if t == k]
            if mine:
                e[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    to, d = near()
    return to, [row[t] for row, t in zip(d, to, strict=True)], e


def odd_rows(n=90, width=64):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 0.2, (6, width))
    v = (centres[rng.integers(0, 6, n)] + rng.normal(0, 0.02, (n, width))).astype(np.float32)
    v[10:40] = v[10]  # copies
    v[50] = -v[51]
    rows = [(int(i) * 3, [float(c) for c in r], None if i % 7 == 0 else int(i % 4)) for i, r in enumerate(v)]
    nan, inf = [float("nan")] + [0.0] * (width - 1), [float("inf")] + [0.0] * (width - 1)
    bad = [(1000, None, 1), (1001, nan, 1), (1002, inf, 2), (1003, [None] + [0.0] * (width - 1), 2), (1004, [0.5] * 3, 1), (1005, [], 1)]
    return rows, bad, v


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "y", "z", 2, 3, 4) for r in rows], SCHEMA)


def test_cover_tree_is_one_and_assigns_like_a_scan():
    from telemsg.llm.cover_tree import assign, build, spread, sums
    from telemsg.llm.vectors import squared

    rng = np.random.default_rng(1)
    for case in range(12):
        n, w = int(rng.integers(1, 700)), int(rng.integers(1, 6))
        x = rng.integers(-40, 40, (n, w)) if case % 3 else np.repeat(rng.integers(-9, 9, (max(1, n // 9), w)), 9, axis=0)
        x = x + 200 * rng.integers(0, 3, (len(x), 1))
        tree = build(x, leaf=4)
        assert sorted(tree.order.tolist()) == list(range(len(x))) and (tree.points == x[tree.order]).all()
        for k in range(len(tree.start)):
            inside = tree.points[tree.start[k] : tree.end[k]]
            assert squared(inside, tree.points[tree.centre[k]][None]).max() ** 0.5 <= tree.radius[k] + 1e-9
            kids = range(tree.child[k], tree.child[k] + tree.children[k])
            if tree.children[k]:  # nesting, separation, cover
                centres = tree.points[tree.centre[list(kids)]]
                assert tree.centre[k] in tree.centre[list(kids)]
                d = squared(centres, centres) ** 0.5
                assert (d[~np.eye(len(centres), dtype=bool)] >= tree.radius[k] / 2 * (1 - 1e-8)).all()
        e = x[rng.integers(0, len(x), 9)] + rng.integers(-2, 3, (9, w))
        ranges = assign(tree, e)
        want = squared(x, e).argmin(1)
        assert (spread(tree, ranges[:3]) == want).all()
        count, total = sums(tree, ranges[:3], 9)
        assert (count == np.bincount(want, minlength=9)).all()
        assert all((total[k] == x[want == k].sum(0)).all() for k in range(9))


def test_whole_subtrees_are_settled_on_clustered_vectors():
    from telemsg.llm.cover_tree import assign, build

    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (20, 8))
    x = centres[rng.integers(0, 20, 3000)] + rng.integers(-20, 20, (3000, 8))
    *_, bulk = assign(build(x), centres)
    assert bulk > 0.9 * len(x)


def test_distances_are_exact_beyond_doubles():
    from telemsg.llm.vectors import largest, squared

    x = np.array([[largest(2), -largest(2)], [3, 4]])
    assert squared(x, x)[0, 1] == (largest(2) - 3) ** 2 + (largest(2) + 4) ** 2 < 2**63


def test_pivot_bounds_lose_nothing_and_save_distances():
    from telemsg.llm.centroids import nearest
    from telemsg.llm.vectors import squared

    rng = np.random.default_rng(3)
    c = rng.integers(-400, 400, (16, 64))
    x = np.concatenate([c[rng.integers(0, 16, 500)] + rng.integers(-30, 30, (500, 64)), (c[:8] + c[8:]) // 2, c])
    d = squared(x, c)
    cluster, distance, exact = nearest(x, d.astype(float) ** 0.5, c, c)
    assert (cluster == d.argmin(1)).all() and (distance == d.min(1)).all()
    assert exact < 0.3 * d.size


def test_vector_codes_against_plain_rounds(spark):
    from telemsg.llm.vector_codes import code_report

    rows, bad, v = odd_rows()
    got = {r.vec_id: r for r in code_report(frame(spark, rows + bad)).collect()}
    x = np.floor(v.astype(np.float64) * 1024).astype(np.int64)
    found = [lloyd(x[:, p * 16 : p * 16 + 16], x[:, p * 16 : p * 16 + 16], 4) for p in range(4)]
    assert set(got) == {r[0] for r in rows}
    books = ",".join(str(c) for f in found for e in f[2] for c in e)
    total = {}
    for i, (_, _, label) in enumerate(rows):
        total[label] = total.get(label, 0) + sum(f[1][i] for f in found)
    for i, (vec_id, _, label) in enumerate(rows):
        r = got[vec_id]
        assert r.code == "".join(f"{f[0][i]:02x}" for f in found)
        assert r.error == sum(f[1][i] for f in found) and r.label_error == total[label]
        assert r.codebooks_sha256 == hashlib.sha256(books.encode()).hexdigest()


def test_blocks_do_not_change_the_codes(spark, monkeypatch):
    from telemsg.llm import vector_codes

    rows, _, _ = odd_rows()
    whole = sorted(map(repr, vector_codes.code_report(frame(spark, rows)).collect()))
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    assert sorted(map(repr, vector_codes.code_report(frame(spark, rows).repartition(5)).collect())) == whole


def test_clusters_against_plain_rounds(spark):
    from telemsg.llm.centroids import cluster_report

    rows, bad, v = odd_rows()
    got = {r.vec_id: r for r in cluster_report(frame(spark, rows + bad)).collect()}
    x = np.floor(v.astype(np.float64) * 64).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda i: hashlib.sha256(f"1:{rows[i][0]}".encode()).hexdigest())[:16]
    to, d, e = lloyd(x, x[first], 3)
    assert set(got) == {r[0] for r in rows}
    for i, (vec_id, _, _) in enumerate(rows):
        r = got[vec_id]
        assert (r.cluster, r.distance, r.inertia) == (to[i], d[i], sum(d))
        assert r.cluster_inertia == sum(b for a, b in zip(to, d, strict=True) if a == to[i])
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, e[to[i]])).encode()).hexdigest()


@pytest.mark.parametrize("case", ["empty", "bad", "few", "repeats"])
def test_odd_tables(spark, case):
    from telemsg.llm.centroids import cluster_report
    from telemsg.llm.vector_codes import code_report

    rows, bad, _ = odd_rows()
    few = {"empty": [], "bad": bad, "few": rows[:3], "repeats": [*rows[:3], rows[0], (None, *rows[4][1:])]}[case]
    kept = [r for r in few if r not in bad]
    for report in (code_report, cluster_report):
        out = report(frame(spark, few)).collect()
        assert sorted(str(r.vec_id) for r in out) == sorted(str(r[0]) for r in kept)
