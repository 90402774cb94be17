"""Bucketed, partitioned, VARIANT and incremental tables: plans and refreshes."""
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not available")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_fill_exchanges_no_telemetry(spark):
    from telemsg.plans.registered_tables import bucketed_fill

    text = plan(bucketed_fill(spark, SF))
    # what is exchanged are the counts per key, the hot slices and broadcasts; the joined rows go by their buckets
    assert "SelectedBucketsCount: 8 out of 8" in text and "SortMergeJoin" in text
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "vin" in line
    below = text[: text.index("SortMergeJoin")]
    assert "Exchange hashpartitioning" not in below


def test_partition_pruning(spark):
    from telemsg.plans.registered_tables import pruned_range, pruned_semi

    assert "PartitionFilters: [isnotnull(dt" in plan(pruned_range(spark, SF))
    assert "dynamicpruning" in plan(pruned_semi(spark, SF))


def test_one_parse_a_document(spark):
    from telemsg.operators import documents as D

    doc = F.lit('{"error": "x", "decoded_values": {"it\'s a": {"decoded_value": "1.5"}, "b": {"decoded_value": "q"}}}')
    df = spark.range(1).select(D.as_variant(F.concat(doc, F.lit(""))).alias("d"))
    r = df.select(
        D.member(F.col("d"), "error").alias("e"), D.field_count(F.col("d")).alias("n"), D.field_value(F.col("d"), "b", "double").alias("bad"),
        D.field_value(F.col("d"), "b").alias("b"), D.field_value(F.col("d"), "no such").alias("none"),
    ).first()
    assert (r.e, r.n, r.bad, r.b, r.none) == ("x", 2, None, "q", None)
    broken = spark.range(1).select(D.as_variant(F.lit("{oops")).alias("d")).select(D.field_count(F.col("d")).alias("n"), D.member(F.col("d"), "e").alias("m")).first()
    assert (broken.n, broken.m) == (0, None)


def test_refresh_rebuilds_what_changed(spark, tmp_path):
    from telemsg.plans.refresh import refresh_codec
    from telemsg.sample.standin import sample_catalogue

    cat = sample_catalogue()
    root = tmp_path / "conversions"
    shutil.copytree(cat.conversions_path, root)
    out = str(tmp_path / "codec")
    codec, rebuilt = refresh_codec(spark, str(root), cat, out)
    first = codec.count()
    assert ("AU", 2025) in rebuilt and refresh_codec(spark, str(root), cat, out)[1] == []
    kept = {p: p.stat().st_mtime_ns for p in Path(out, "codec").rglob("*.parquet")}
    layout = root / "AU" / "2025" / "DDT_BCM_C1F0_AU_2025.json"
    layout.write_text(layout.read_text().replace("Supply Voltage Raw", "Supply Voltage Renamed"))
    codec, rebuilt = refresh_codec(spark, str(root), cat, out)
    assert rebuilt == [("AU", 2025)] and codec.count() == first
    names = codec.where("family = 'AU' AND msg = 'C1F0'").select("year", F.explode("fields.description").alias("d")).collect()
    assert {r.year for r in names if r.d == "Supply Voltage Renamed"} == {2025}
    after = {p: p.stat().st_mtime_ns for p in Path(out, "codec").rglob("*.parquet")}
    assert {p for p in kept if "family=AU/year=2025" not in str(p)} == {p for p in after if "family=AU/year=2025" not in str(p)}
    shutil.rmtree(root / "MA" / "2025")
    codec, rebuilt = refresh_codec(spark, str(root), cat, out)
    assert rebuilt == [("MA", 2025)] and codec.where("family = 'MA' AND year = 2025").count() == 0


def test_saved_counts_come_from_the_write(spark, tmp_path):
    from telemsg.plans.sinks import save_with_summary

    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2), (None, None)], "MODEL_CODE string, MODEL_YEAR int")
    out = save_with_summary(df, str(tmp_path / "t"), "1", "2", [("A", 1), ("Z", 9)])
    assert sorted((r.MODEL_CODE or "", r.rows, r.total_rows) for r in out.collect()) == [("", 2, 4), ("A", 2, 4), ("Z", 0, 4)]
    assert spark.read.parquet(str(tmp_path / "t")).select("processing_timestamp").distinct().collect() == out.select("processing_timestamp").distinct().collect()


def test_whole_variants_are_one_value_a_row(spark, tmp_path):
    """No column a path in the files, the same values, and the session's own setting afterwards."""
    import pyarrow.parquet as pq

    from telemsg.operators import documents as D
    from telemsg.plans.sinks import whole_variants, write_table

    key, path = "spark.sql.variant.inferShreddingSchema", str(tmp_path / "v")
    before = spark.conf.get(key, None)
    text = F.format_string('{"error": "e%d", "decoded_values": {"a": {"decoded_value": "%d"}, "b": {"decoded_value": "x"}}}', "id", "id")
    with whole_variants(spark):
        write_table(spark.range(300).coalesce(1).select("id", D.as_variant(text).alias("d")), path)
    assert spark.conf.get(key, None) == before
    for f in Path(path).glob("*.parquet"):
        assert sorted(c.path for c in pq.ParquetFile(f).schema) == ["d.metadata", "d.value", "id"]
    got = spark.read.parquet(path).select("id", D.member(F.col("d"), "error").alias("e"), D.field_value(F.col("d"), "a", "int").alias("a"), D.field_count(F.col("d")).alias("n"))
    assert all((r.e, r.a, r.n) == (f"e{r.id}", r.id, 2) for r in got.collect())


def test_decoded_rows_carry_no_codec_fields(spark, tmp_path):
    """The rows of the compiled decode are those of the interpreted one, and hold of the codec what documents show."""
    from telemsg.operators.decode import decode
    from telemsg.operators.validate import validity_expr
    from telemsg.plans.batch import attach_family_dimension
    from telemsg.plans.registered import MSG_COLS, _decoded_rows, _dimension, _joined

    sf = str(tmp_path)
    e = spark.range(600).select(
        F.when(F.col("id") % 97 != 0, F.col("id") % 500).alias("event_id"), F.timestamp_seconds(F.col("id") * 977 + 1704067200).alias("ts"),
        F.when(F.col("id") % 89 != 0, F.col("id") % 40).alias("user_id"), F.lit("click").alias("event_type"), F.col("id").cast("double").alias("value"),
    )
    e.write.parquet(f"{sf}/events.parquet")
    names = F.array(*[F.lit(x) for x in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "XX")])
    c = spark.range(42).select(
        (F.col("id") % 40).alias("c_custkey"), F.lit("n").alias("c_name"), F.when(F.col("id") % 11 != 0, F.col("id") % 25).cast("int").alias("c_nationkey"),
        names[(F.col("id") % 7).cast("int") % 6].alias("c_mktsegment"),
    )
    c.write.parquet(f"{sf}/customer.parquet")
    got = _decoded_rows(spark, sf)
    assert got.schema["codec"].dataType.fieldNames() == ["layout_name", "broken"]
    df = attach_family_dimension(_joined(spark, sf), _dimension(spark, False))
    texts = lambda d: sorted(map(str, d.collect()))
    keys = ["event_id", "MODEL_CODE", "MODEL_YEAR", "msg", "text", "is_valid", F.col("codec.layout_name").alias("layout"), F.col("codec.broken").alias("broken"), "decoded"]
    wanted = []
    for m, col in MSG_COLS.items():
        valid = F.coalesce(validity_expr(F.col(col), F.col(f"{m}_reference_len")), F.lit(False))
        one = df.withColumns({"msg": F.lit(m), "text": F.col(col), "codec": F.col(f"{m}_codec"), "is_valid": valid})
        wanted += texts(decode(one, "text", "codec", "decoded", valid_col="is_valid").select(*keys))
    found = texts(got.select(*keys))
    assert len(found) > 1000 and found == sorted(wanted) and sum("decoded=[" in x for x in found) > 100
