"""Pipeline stages on rows that lack an id or share one."""

import random

from .helpers import sentence


def test_decontamination_by_row(spark, tmp_path):
    import corpus_pipeline as P

    rng = random.Random(5)
    passage = sentence(rng, 20)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    leaky = f"{sentence(rng, 10)} {passage} {sentence(rng, 10)}"
    clean = [sentence(rng, 40) for _ in range(3)]
    rows = [(None, leaky), (None, clean[0]), (7, leaky), (7, clean[1]), (8, clean[2]), (8, clean[2]), (9, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in P.decontaminate(spark, docs, str(tmp_path)).collect()]
    want = [r for r in rows if r[1] != leaky]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_near_duplicates_by_row(spark):
    import corpus_pipeline as P

    rng = random.Random(6)
    a, b, c, d, e = (sentence(rng, 60) for _ in range(5))
    close = " ".join([*a.split()[:-1], "other"])
    rows = [
        (1, a), (1, a), (2, close), (2, e), (None, close),  # one group; the second row of 2 is alone
        (None, b), (None, b), (None, " ".join([*b.split()[:-1], "other"])),  # a group without ids
        (5, c), (5, c), (6, d), (None, None), (None, ""), (7, ""), (7, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in P.near(spark, docs, "").collect()]
    again = [tuple(r) for r in P.near(spark, docs.repartition(3), "").collect()]
    none = [t for i, t in got if i is None and t]
    assert len(none) == 1 and none[0] in {t for i, t in rows[5:8]}
    want = [(1, a), (2, e), (None, none[0]), (5, c), (6, d), (None, None), (None, ""), (7, ""), (7, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr) == sorted(again, key=repr)
