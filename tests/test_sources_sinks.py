"""Conversion files by header and unit, layout files, sinks, coverage, dates, JSON documents, byte map."""

import json
import random

import pytest
from helpers import codec_from_rows
from pyspark.sql import functions as F

from telemsg.catalogue import local_rows
from telemsg.operators.bytemap import byte_map, field_map
from telemsg.operators.codec import build_codec
from telemsg.operators.decode import decode, decoded_json
from telemsg.operators.flatten import add_dt_if_missing
from telemsg.operators.timeline import forward_fill, forward_fill_window
from telemsg.operators.validate import codec_coverage, prepare_family
from telemsg.plans.joins import checked_broadcast
from telemsg.plans.sinks import read_merged, write_table
from telemsg.sources.conversions import read_layout_csv, read_layouts, read_linear, read_table, write_layout_json

LINEAR = "ID,Description,Size,Factor (m),Offset (b),Type,Decimal Places,Units,Scaled Min,Scaled Max,Raw Min,Raw Max,Encoding Name"


def put(root, name, text):
    p = root / "DT" / "2025" / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)


def test_files_are_read_by_header_name(spark, tmp_path):
    put(tmp_path, "conv_T_BCM_DT_2025.csv", '﻿ID,Description,Min,Max,Encoding Name\r\n7,"a, b",$1,$1,"Lamp ""on"""\r\n\r\n7,x,$2\r\n')
    put(tmp_path, "conv_T_ABS_DT_2025.csv", "Encoding Name,Min,ID\nOther,$1,7\n")
    rows = read_table(spark, str(tmp_path)).orderBy("ecu", "ord").collect()
    assert [(r.ecu, r.ID, r.Min, r["Encoding Name"]) for r in rows] == [
        ("ABS", "7", "$1", "Other"), ("BCM", "7", "$1", 'Lamp "on"'), ("BCM", "7", "$2", None)
    ]
    put(tmp_path, "conv_T_TCM_DT_2025.csv", "ID,Encoding Name\n1,x\n")
    with pytest.raises(Exception, match="no column 'Min'"):
        read_table(spark, str(tmp_path)).collect()


def test_conversion_rows_stay_with_their_unit(spark, tmp_path):
    put(tmp_path, "conv_L_BCM_DT_2025.csv", f"{LINEAR}\n5,x,1,2,0,U,0,,,,$00,$FF,\n")
    put(tmp_path, "conv_L_ABS_DT_2025.csv", f"{LINEAR}\n5,x,1,9,100,U,0,,,,$00,$FF,\n")
    entry = [{"byte": "1 [0]", "description": "v", "size": "1 [0]", "type": "L", "name": "n", "id": "5"}]
    for ecu in ("BCM", "ABS"):
        put(tmp_path, f"DDT_{ecu}_M{ecu}_DT_2025.json", json.dumps({"name": ecu, "entries": entry}))
    root = str(tmp_path)
    codec = build_codec(read_layouts(spark, root), read_linear(spark, root), read_table(spark, root))
    got = {r.msg: (r.has_table, r.fields[0].lin.factor) for r in codec.collect()}
    assert got == {"MBCM": (False, 2.0), "MABS": (False, 9.0)}


def test_layout_csv_round_trip(spark, tmp_path):
    src = tmp_path / "csv"
    src.mkdir()
    (src / "DDT_BCM_A7_DT_2025.csv").write_text(
        "Note,ByteBit,ByteBit_Description,Size,Type,Name,ID,Default_Value\nn,0 [0],one,1 [0],I,-,1,\nn,1 [0],two,1 [0],L,x,2,$FF\n"
    )
    layouts = read_layout_csv(spark, str(src / "*.csv"))
    write_layout_json(layouts, str(tmp_path / "out"))
    rows = read_layouts(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [(r.family, r.year, r.ecu, r.msg, r.description, r.default_value) for r in rows] == [
        ("DT", 2025, "BCM", "A7", "one", None), ("DT", 2025, "BCM", "A7", "two", "$FF")
    ]
    (src / "DDT_BCM_A8_DT_2025.csv").write_text("ByteBit,ByteBit_Description,Size,Type,Name\n0 [0],one,1 [0],I,-\n")
    with pytest.raises(Exception, match="no column 'ID'"):
        read_layout_csv(spark, str(src / "*.csv")).collect()


def test_append_with_a_new_column(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 2.5)], "id int, b double")
    path = str(tmp_path / "t")
    for target, read in ((path, lambda: read_merged(spark, path)), ("appended_t", lambda: spark.table("appended_t"))):
        spark.sql("DROP TABLE IF EXISTS appended_t")
        write_table(a, target, "append")
        write_table(b, target, "append")
        assert sorted(tuple(r) for r in read().select("id", "a", "b").collect()) == [(1, "x", None), (2, None, 2.5)]
    spark.sql("DROP TABLE appended_t")


def test_coverage_reports_each_part(spark):
    keys = spark.createDataFrame([("A", 1, "M"), ("B", 1, "M")], "family string, year int, msg string")
    codec = spark.createDataFrame([("A", 1, "M")], "family string, year int, msg string")
    linear = spark.createDataFrame([("B", 1)], "family string, year int")
    got = codec_coverage(keys, codec, linear, linear.limit(0)).collect()
    assert sorted(map(tuple, got)) == [("A", 1, "M", True, False, False), ("B", 1, "M", False, True, False)]


def test_family_without_lengths_is_not_filtered(spark):
    df = spark.createDataFrame([("A", 1, "00"), ("A", 1, "0000"), ("B", 1, "00")], "MODEL_CODE string, MODEL_YEAR int, m string")
    lengths = spark.createDataFrame([("A", 1, "M", 4)], "family string, year int, msg string, length int")
    assert prepare_family(df, "A", 1, lengths, ["M"], {"M": "m"}).collect()[0].m == "0000"
    with pytest.warns(UserWarning, match="no lengths"):
        assert prepare_family(df, "B", 1, lengths, ["M"], {"M": "m"}).count() == 1


def test_dates_and_documents(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("soon",), (None,)], "app_timestamp string")
    assert [str(r.dt) for r in add_dt_if_missing(df).collect()] == ["2024-01-05", "None", "None"]
    assert [str(r.dt) for r in add_dt_if_missing(df, fmt="MM-dd-yyyy").collect()] == ["None"] * 3
    codec = codec_from_rows(spark, [("0 [0]", "v", "1 [0]", "I", "-", "1")]).select(
        F.struct("has_linear", "has_table", "broken", "fields", "layout_name").alias("c")
    )
    rows = spark.createDataFrame([(1, "62", True), (2, "", True), (3, None, True), (4, "62", False)], "i int, m string, known boolean")
    d = rows.crossJoin(codec).withColumn("c", F.when(F.col("known"), F.col("c")))
    d = decode(d, "m", "c", "x")
    def doc(**how):
        return decoded_json(F.col("x"), F.col("m"), F.col("c"), F.lit("F"), F.lit(2025), "M", **how)
    got = {r.i: r for r in d.select("i", doc().alias("n"), doc(on_error="object", on_empty="object").alias("o")).collect()}
    assert json.loads(got[1].n)["decoded_values"]["v"]["decoded_value"] == "98" and got[1].n == got[1].o
    assert got[2].o == got[3].o == '{"error":"Empty DDT string"}' and got[3].n is None and got[4].n is None
    assert json.loads(got[4].o) == {"error": "Structure file not found", "ddt_type": "M", "family": "F", "year": 2025}


def test_byte_map_edges(spark):
    entries = [("0 [0]", "back", "1 [1]", "I", "-", "1"), ("1 [4]", "shift", "1 [2]", "I", "-", "2"), ("2 [0]", "last", "1 [0]", "I", "-", "3"),
               ("0 [0]", "wide", "12 [0]", "I", "-", "4")]
    codec = codec_from_rows(spark, entries).select(F.struct("has_linear", "has_table", "broken", "fields", "layout_name").alias("c"))
    d = decode(spark.createDataFrame([(1, "62A0F1")], "i int, m string").crossJoin(codec), "m", "c", "x")
    got = {r.description: (r.first_byte, r.last_byte, r.covered_hex, r.covered_binary) for r in field_map(d, "i", "m", "x").collect()}
    assert got["back"] == (0, 0, "62", "01100010")
    assert got["shift"] == (0, 2, "62A0F1", "011000101010000011110001")
    assert got["wide"][2] == "62A0F1" and len(got["wide"][3]) == 24
    readers = {r.byte: r.fields for r in byte_map(d, "i", "m", "x").collect()}
    assert readers[2] == ["shift", "last", "wide"]


@pytest.mark.parametrize("kind", ["long", "double", "timestamp", "date"])
def test_fill_by_other_orders_and_null_keys(spark, kind):
    rng = random.Random(3)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([None, *range(0, 2_000_000, 40_000)]), i, rng.choice([None, None, rng.random()]))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "vin string, o long, i int, v double")
    if kind in ("timestamp", "date"):
        df = df.withColumn("o", F.timestamp_seconds("o"))
    df = df.withColumn("o", F.col("o").cast(kind))
    a = forward_fill(df, ["v"], "vin", ["o", "i"]).select("i", "v_reference")
    b = forward_fill_window(df, ["v"], "vin", ["o", "i"]).select("i", "v_reference")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_wide_side_is_shuffled_once(spark):
    """Two exchanges of the summary, one of the rows, which join and window share."""
    df = spark.range(100).select(F.col("id").cast("string").alias("vin"), F.col("id").alias("o"), F.col("id").alias("v"), F.lit("w").alias("wide"))
    plan = forward_fill(df, ["v"], "vin", ["o"]).select("wide", "v_reference")._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in x and "wide" in x for x in plan.split("\n")) <= 1


def test_broadcast_goes_by_planned_bytes(spark):
    small = local_rows(spark, [(1,)], "k int")
    hinted = lambda d: "Hint" in d._jdf.queryExecution().logical().toString()
    assert hinted(checked_broadcast(small)) and not hinted(checked_broadcast(small, 1))
