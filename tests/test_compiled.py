"""The compiled codec against the interpreted one, and against Python's whole numbers where that stops at 63 bits."""
import random
from types import SimpleNamespace

import numpy as np
from helpers import codec_from_rows
from pyspark.sql import functions as F

from telemsg.operators import compiled as K
from telemsg.operators.decode import decode

L = 44


def linear_row(i, factor, offset, decimals, lo, hi, label=""):
    row = {"ID": i, "Factor (m)": factor, "Offset (b)": offset, "Decimal Places": decimals, "Raw Min": lo, "Raw Max": hi, "Encoding Name": label}
    from telemsg.sources.conversions import LINEAR_COLUMNS

    return [row.get(c, "") for c in LINEAR_COLUMNS]


def table_row(i, text, label):
    from telemsg.sources.conversions import TABLE_COLUMNS

    return [{"ID": i, "Min": text, "Encoding Name": label}.get(c, "") for c in TABLE_COLUMNS]


LINEAR = [
    linear_row("1", "0.05", "5", "2", "$00", "$FE"), linear_row("1", "", "", "", "$F0", "$F3", "Warming up"),
    linear_row("2", "0.001", "0", "3", "$0000", "$FFFE"), linear_row("2", "", "", "", "$0105", "$0105", "12"),
    linear_row("3", "2", "-40", "0", "$00", "$0FFF"), linear_row("4", "1e-7", "0", "9", "$00", "3.00E+08"),
    linear_row("5", "", "", "0", "$00", "$FF"), linear_row("6", "1000000", "0.5", "1", "$00", "70000"),
]
TABLE = [table_row("7", f"${k:X}", f"label {k}") for k in (0, 1, 2, 5, 9, 77, 300, 4000, 65535)]
TABLE += [table_row("8", "$01", "Error of the sensor"), table_row("8", "$2", "it's \\ fine")]


def setup(spark, entries, length=L):
    codec = codec_from_rows(spark, entries, LINEAR, TABLE)
    spec = SimpleNamespace(msg="M", column_name="m", lengths=(("DT", 2025, length),))
    return codec, spec, K.compile_codec(codec, SimpleNamespace(messages=[spec]))


def both(spark, entries, messages, length=L):
    """{message: fields} interpreted and compiled, for messages of the expected length."""
    codec, spec, compiled = setup(spark, entries, length)
    df = spark.createDataFrame([(m,) for m in messages], "m string")
    row = codec.select(F.struct("has_linear", "has_table", "broken", "fields", "layout_name").alias("codec"))
    want = decode(df.crossJoin(row), "m", "codec", "d").select("m", "d").collect()
    ready = K.prepared(df.withColumn("M_layout", F.lit(0)), compiled, {"M": "m"})
    got = ready.select("m", K.decoded_array(compiled, spec).alias("d")).collect()
    return {r.m: r.d for r in want}, {r.m: r.d for r in got}


def test_random_layouts_agree(spark):
    rng = random.Random(11)
    entries = []
    for i in range(70):
        n, k = rng.choice([(0, 0), (0, rng.randint(1, 9)), (rng.randint(1, 3), 0), (rng.randint(1, 4), rng.randint(1, 9)), (rng.randint(1, 10), 0)])
        entries.append((f"{rng.randint(-1, 22)} [{rng.randint(0, 8)}]", f"f{i}", f"{n} [{k}]", rng.choice("LLTTI-"), rng.choice(["x", "Door Fault/No Fault"]), rng.choice("123456789") if rng.random() < 0.9 else "no id"))
    messages = ["".join(rng.choices("0123456789ABCDEFabcdef", k=L)) for _ in range(60)] + ["F" * L, "0" * L]
    for _ in range(30):
        m = list(rng.choice(messages[:20]))
        for _ in range(rng.randint(1, 3)):
            m[rng.randrange(L)] = rng.choice("ZG# ")
        messages.append("".join(m))
    want, got = both(spark, entries, messages)
    for m in messages:
        for x, y in zip(want[m], got[m], strict=True):
            if not x.raw_position.startswith("-") and "wider than 63 bits" not in x.decoded_value:
                assert x == y, (m, x, y)


def test_every_raw_value(spark):
    """Tables of finished values and the search tree, over all raw values of one and two bytes."""
    entries = [("0 [0]", f"b{i}", "1 [0]", t, "x", i) for i, t in (("1", "L"), ("5", "L"), ("7", "T"), ("8", "T"), ("x", "T"))]
    entries += [("0 [0]", f"w{i}", "2 [0]", t, "x", i) for i, t in (("2", "L"), ("3", "L"), ("4", "L"), ("6", "L"), ("7", "T"))]
    want, got = both(spark, entries, [f"{i:04X}" for i in range(0, 65536, 3)] + ["FFFF", "FFFE", "0FA0", "012C"], 4)
    assert want == got
    assert got["012C"][9].decoded_value == "label 300" and got["FFFF"][9].decoded_value == "label 65535"


def test_typed_columns_and_layouts(spark):
    """Two layouts of one message, as typed columns; null where a row has no layout or is not valid."""
    codec, spec, compiled = setup(spark, [("0 [0]", "a", "1 [0]", "L", "x", "1"), ("1 [0]", "b", "2 [0]", "L", "x", "2")], 6)
    other, _, second = setup(spark, [("1 [0]", "a", "1 [0]", "I", "x", "9"), ("0 [0]", "c", "1 [0]", "T", "x", "7")], 4)
    m = compiled.messages["M"]
    m.layouts.append(second.messages["M"].layouts[0])
    for checks in second.messages["M"].checks:
        m.checks.setdefault(checks, len(m.checks))
    compiled.tables.update(second.tables)
    from pyspark.sql import types as T

    cols = [SimpleNamespace(description=d, clean_name=f"{d}_{n}", spark_type=t) for d in "abc" for n, t in (("t", T.StringType()), ("d", T.DoubleType()), ("i", T.IntegerType()))]
    rows = [("0A0105", 0), ("F1FFFF", 0), ("010A", 1), ("0A0105", None), (None, 0), ("ZZ0105", 0)]
    df = K.prepared(spark.createDataFrame(rows, "m string, M_layout int"), compiled, {"M": "m"})
    got = df.select(*K.typed_columns(compiled, SimpleNamespace(msg="M", column_name="m", columns=cols))).collect()
    assert tuple(got[0]) == ("5.5", 5.5, None, "0.261", 0.261, None, None, None, None)
    assert tuple(got[1]) == ("Warming up", None, None, "Invalid/Not Available", None, None, None, None, None)
    assert tuple(got[2]) == ("10", 10.0, 10, None, None, None, "label 1", None, None)
    assert all(v is None for v in got[3]) and all(v is None for v in got[4])
    assert got[5][0].startswith("Error: invalid literal") and got[5][1] is None and got[5][3] == "0.261"


def python_value(m, b, t, n, k):
    """The position rules on Python's whole numbers."""
    data = bytes.fromhex(m)
    if k == 0:
        return int.from_bytes(data[b : b + n], "big")
    value = int.from_bytes(data[b : b + n], "little")
    if t:
        if b + n < len(data):
            value |= (data[b + n] & ((1 << t) - 1)) << (8 * n)
        value = (value >> t) & ((1 << (8 * n)) - 1)
    return value | ((data[b - 1] & ((1 << k) - 1)) << (8 * n))


def test_wide_fields_are_whole_numbers(spark):
    places = [(b, t, n, k) for n in (7, 8, 9, 15, 16, 17, 20) for b in (1, 2) for t, k in ((0, 0), (0, 1), (3, 4), (7, 8))]
    entries = [(f"{b} [{t}]", f"{b},{t},{n},{k}", f"{n} [{k}]", "I", "x", "9") for b, t, n, k in places]
    entries += [("1 [0]", f"lin{i}", "9 [0]", "L", "x", i) for i in ("4", "3")] + [("1 [0]", "tab", "8 [0]", "T", "x", "7")]
    rng = random.Random(3)
    messages = ["F" * L, "0" * L, "00" * 12 + "01" * 10] + ["".join(rng.choices("0123456789abcdef", k=L)) for _ in range(12)]
    _, got = both(spark, entries, messages)
    for m in messages:
        for (b, t, n, k), x in zip(places, got[m], strict=False):
            assert x.decoded_value == str(python_value(m, b, t, n, k)), (m, b, t, n, k)
        nine, eight = python_value(m, 1, 0, 9, 0), python_value(m, 1, 0, 8, 0)
        lin, cut, tab = got[m][len(places) :]
        if nine >= 2**63:
            assert lin.decoded_value == str(float(np.rint(nine * 1e-7 * 1e9) / 1e9)) and lin.raw_value is None and lin.raw_wide == str(nine)
            assert cut.decoded_value == "Out of Range/Invalid"
        if eight >= 2**63:
            assert tab.decoded_value == f"0x{eight:X} (No match)"


def test_whole_part_of_large_floats(spark):
    from telemsg.functions.numeric import whole_float_text

    xs = [2.0**63, 2.0**64, 1.5e19, -(2.0**70) + 2.0**20, 1e30, 1.7976931348623157e308, 9007199254740993.0, 2.0**64 - 2048, -7.9, 0.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", whole_float_text(F.col("x")).alias("t")).collect()
    assert all(r.t == str(int(r.x)) for r in got)


def test_plain_messages_read_wide_fields_by_parts(spark, monkeypatch):
    """The rules in full, which go by character, are left to messages with other characters or of another length."""
    places = [(b, t, n, k) for n in (8, 9, 16, 20) for b in (1, 2) for t, k in ((0, 0), (0, 1), (3, 4), (7, 8))]
    entries = [(f"{b} [{t}]", f"{b},{t},{n},{k}", f"{n} [{k}]", "I", "x", "9") for b, t, n, k in places]
    rng = random.Random(5)
    plain = ["F" * L, "0" * L, "00" * 13 + "7" * 18, "00" * 10 + "80" + "00" * 11] + ["".join(rng.choices("0123456789ABCDEFabcdef", k=L)) for _ in range(8)]
    odd = ["zz" + "12" * 21, "12" * 9 + "  0g" + "34" * 11, "AB" * 30, "CD" * 12, ""]
    kept = K.W.read_wide
    wanted = spark.createDataFrame([(m,) for m in odd], "m string").select(
        "m", F.array(*[kept(F.col("m"), F.length("m"), F.col("m").rlike("^[0-9A-Fa-f]*$"), *map(F.lit, p)) for p in places[::5]]).alias("d")
    )
    wanted = {r.m: r.d for r in wanted.collect()}
    _, _, compiled = setup(spark, entries)
    ready = K.prepared(spark.createDataFrame([(m, 0) for m in odd], "m string, M_layout int"), compiled, {"M": "m"})
    for r in ready.select("m", "M_full").collect():
        found = dict(zip(compiled.messages["M"].full, r.M_full, strict=True))
        assert all(found[*p, L] == x for p, x in zip(places[::5], wanted[r.m], strict=True) if (*p, L) in found), r.m

    def not_here(*_):
        none = F.lit(None).cast("string")
        return F.struct(F.raise_error(F.lit("read in full")).cast("bigint").alias("raw"), none.alias("wide"), none.alias("err"), none.alias("digits"))

    monkeypatch.setattr(K.W, "read_wide", not_here)
    _, got = both(spark, entries, plain)
    for m in plain:
        assert [x.decoded_value for x in got[m]] == [str(python_value(m, *p)) for p in places]
