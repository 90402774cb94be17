"""The sliced forward fill equals the single-window fill, hot keys, ties and nulls included; its plan moves rows once."""
import random
import re

import pytest
from pyspark.sql import functions as F

from telemsg.operators.timeline import forward_fill, forward_fill_window, hot_cuts


def rows(n=3000, seed=7):
    rnd = random.Random(seed)
    for i in range(n):
        vin = "HOT" if rnd.random() < 0.4 else None if rnd.random() < 0.1 else f"V{rnd.randint(0, 30)}"
        day = 5 if vin == "HOT" else rnd.randint(1, 28)  # the hot key's rows are all of one day
        ts = f"2024-01-{day:02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00" if rnd.random() > 0.02 else None
        v = None if rnd.random() < 0.6 else rnd.random()
        s = None if rnd.random() < 0.9 else rnd.choice(["ON", "OFF"])
        yield vin, ts, i, v, s


@pytest.mark.parametrize("order", [["app_timestamp", "eid"], ["at", "eid"], ["eid"], ["day", "eid"]])
@pytest.mark.parametrize("slice_rows", [40, 100_000])
def test_sliced_fill_matches_window(spark, order, slice_rows):
    df = spark.createDataFrame(list(rows()), "vin string, app_timestamp string, eid int, v double, s string")
    df = df.withColumns({"at": F.col("app_timestamp").cast("timestamp"), "day": F.to_date("app_timestamp")})
    a = forward_fill(df, ["v", "s"], "vin", order, slice_rows=slice_rows).select("eid", "v_reference", "s_reference")
    b = forward_fill_window(df, ["v", "s"], "vin", order).select("eid", "v_reference", "s_reference")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.count() == 3000


def test_hot_keys_alone_are_cut(spark):
    df = spark.createDataFrame(list(rows()), "vin string, app_timestamp string, eid int, v double, s string")
    cuts = {r._hot_key: len(r._cuts) for r in hot_cuts(df, "vin", ["app_timestamp", "eid"], 200).collect()}
    assert set(cuts) == {"HOT", None} or set(cuts) == {"HOT"}
    assert 2 <= cuts["HOT"] <= 12  # 1,200 rows in slices of about 200


def test_empty_and_no_columns(spark):
    df = spark.createDataFrame([], "vin string, app_timestamp string, v double")
    assert forward_fill(df, ["v"]).columns == ["vin", "app_timestamp", "v", "v_reference"]
    assert forward_fill(df, ["v"]).count() == 0 and forward_fill(df, []).columns == df.columns


def test_wide_rows_move_once(spark, tmp_path):
    wide = ", ".join(f"'x{i}' AS w{i}" for i in range(12))
    spark.sql(f"SELECT CAST(id % 7 AS STRING) AS vin, id AS eid, CAST(id AS DOUBLE) AS v, {wide} FROM range(2000)").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = forward_fill(df, ["v"], "vin", ["eid"], slice_rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len([s for s in scans if "w0#" in s]) == 1  # the wide columns are read by one scan
    assert not re.search(r"SortMergeJoin", plan)
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([x for x in exchanged if "_slice" in x and "partial" not in x]) <= 2
