"""Every corpus query against its SQL, and the pipeline against stages done plainly."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not available")


def rows(pdf, cols):
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    whole = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    return sorted(repr([whole(v) for v in r]) for r in pdf.to_numpy().tolist())


def test_queries_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from telemsg.llm.oracle import ORACLE_SQL
    from telemsg.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        got, want = QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns), name
        assert rows(got, cols) == rows(want, cols), name


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == [
        "quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "mix_sources"
    ]
    kept = docs
    for _, stage in P.STAGES[:-1]:
        after = P.written(stage(spark, kept, SF), "t")
        assert after.columns == docs.columns and 0 < after.count() <= kept.count()
        kept = after
    last = P.STAGES[-1][1](spark, kept, SF)
    assert sorted(map(repr, last.collect())) == sorted(map(repr, P.run(spark, SF).collect()))
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_against_plain_python(spark):
    import corpus_pipeline as P

    from .test_decontaminate import norm
    from .test_line_dedup import brute as dedup
    from .test_minhash import brute as near

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = {r.doc_id: r.text for r in P.STAGES[0][1](spark, docs, SF).collect()}
    bench = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lines = {i: t for i, _, _, t in dedup(list(quality.items()), 10)}
    verdict = near(lines.items(), 80)
    kept = {i: t for i, t in lines.items() if verdict[i][2]}
    clean = {i for i, t in kept.items() if not any(b in norm(t) for b in bench)}
    assert {r.doc_id for r in P.run(spark, SF).collect()} == clean
