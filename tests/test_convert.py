"""Linear (L1-L7) and table (T1-T4) rules."""
import json

import numpy as np

from helpers import codec_from_rows, decode_values

H = ["ID", "Description", "Size", "Factor (m)", "Offset (b)", "Type", "Decimal Places", "Units", "Scaled Min",
     "Scaled Max", "Raw Min", "Raw Max", "Encoding Name"]


def lrow(i, f, o, d, rmin, rmax, label=""):
    return (str(i), "x", "1 [0]", f, o, "Unsigned", d, "", "", "", rmin, rmax, label)


def one_byte(spark, linear, entries_id, raws, table=(), typ="L", name="n"):
    entries = [("1 [0]", "v", "1 [0]", typ, name, entries_id)]
    codec = codec_from_rows(spark, entries, linear, table)
    msgs = [f"62{r:02X}" for r in raws]
    got = decode_values(spark, codec, msgs)
    return [got[m][0][1] for m in msgs]


def test_linear_rules(spark):
    lin = [
        lrow(1, "1", "-40", "0", "$00", "$C8"), lrow(1, "", "", "", "$FF", "$FF", "No Signal"),
        lrow(2, "0.5", "0", "1", "$00", "$FE"), lrow(2, "", "", "", "$10", "$1F", "Range"),
        lrow(3, "", "0", "0", "$00", "$FF"),
        lrow(4, "0.05", "5", "1", "$00", "3.00E+08"),
    ]
    assert one_byte(spark, lin, "1", [0, 200, 201, 255]) == ["-40", "160", "Out of Range/Invalid", "No Signal"]
    assert one_byte(spark, lin, "2", [16, 31, 32, 255]) == ["Range", "Range", "16.0", "Out of Range/Invalid"]
    assert one_byte(spark, lin, "3", [5]) == ["Conv Error: cannot convert float NaN to integer"]
    assert one_byte(spark, lin, "999", [42]) == ["42"]
    assert one_byte(spark, lin, "-", [42]) == ["Conv Error: invalid literal for int() with base 10: '-'"]
    # numpy rounding of 7 * 0.05 + 5 = 5.35 (binary 5.3499999...) -> rint(53.5) = 54 -> 5.4
    assert one_byte(spark, lin, "4", [7]) == [repr(float(np.round(np.float64(7) * 0.05 + 5, 1)))]


def test_table_rules(spark):
    tab = [("7", "$0", "Zero"), ("7", "$04", "Four"), ("7", " $1 ", "One"), ("7", "$1", "dup"), ("7", "$1A", "Big")]
    assert one_byte(spark, [], "7", [0, 1, 4, 26, 27], tab, "T") == ["Zero", "One", "Four", "Big", "0x1B (No match)"]
    assert one_byte(spark, [], "8", [1, 0], tab, "T", "Fault/No Fault") == ["Fault", "No Fault"]
    assert one_byte(spark, [], "-", [26], tab, "T") == [
        "0x1A (Conv Error: invalid literal for int() with base 10: '-')"]
    assert one_byte(spark, [], "7", [26], (), "T") == ["0x1A"]  # no table file


def test_label_that_begins_with_error_hides_the_raw_value(spark):
    tab = [("7", "$0", "Error in unit"), ("7", "$1", "No Error")]
    codec = codec_from_rows(spark, [("1 [0]", "v", "1 [0]", "T", "n", "7")], (), tab)
    got = decode_values(spark, codec, ["6200", "6201"])
    assert got["6200"] == [("v", "Error in unit", None)] and got["6201"] == [("v", "No Error", 1)]


def made_up_table():
    """Factors, offsets and decimals like those of real tables, with ties of rounding among their values."""
    rng = np.random.default_rng(11)
    factors = [0.1, 0.05, 0.025, 0.0125, 0.5, 0.25, 0.001, 0.002, 1 / 3, 2.5, 0.0039, 0.00390625, *rng.uniform(0, 2, 20).round(5)]
    return [(i, float(f), float(o), d) for i, (f, o, d) in enumerate(
        (f, o, d) for f in factors for o, d in ((0, 1), (-40, 2), (5, 2), (0.5, 3)))]


def test_rounding_is_numpys(spark):
    """Every raw value 0-1023 of every row: numpy's own round, as a table row read with pandas hands back
    ``numpy.float64`` and Python's ``round`` calls numpy's method on it."""
    import pandas as pd
    from pyspark.sql import functions as F

    from telemsg.functions.numeric import numpy_round, python_float_text

    table = pd.DataFrame(made_up_table(), columns=["id", "f", "o", "d"])
    rows, expect, ties = [], {}, 0
    for _, r in table.iterrows():
        first = table[table["id"] == r["id"]].iloc[0]
        assert isinstance(first["f"], np.float64)
        for raw in range(1024):
            x = raw * first["f"] + first["o"]
            expect[int(r["id"]), raw] = json.dumps(round(x, int(first["d"])))
            ties += round(x, int(first["d"])) != round(float(x), int(first["d"]))
            rows.append((int(r["id"]), raw, float(r["f"]), float(r["o"]), int(r["d"])))
    assert ties > 0  # the two rounding rules differ here, so the test tells them apart
    x = F.col("raw").cast("double") * F.col("f") + F.col("o")
    sdf = spark.createDataFrame(rows, "id long, raw long, f double, o double, d int")
    got = sdf.select("id", "raw", python_float_text(numpy_round(x, F.col("d"))).alias("t")).collect()
    assert [g for g in got if g.t != expect[g.id, g.raw]][:5] == []
