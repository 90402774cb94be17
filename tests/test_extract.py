"""Extraction rules E1-E7 on the worked examples of the fixtures (message 62A001F0)."""
from helpers import codec_from_rows, decode_values

MSG = "62A001F0"
CASES = [  # (byte, size, expected decoded value)
    ("0 [1]", "0 [3]", "1"),
    ("1 [0]", "2 [0]", "40961"),
    ("1 [0]", "1 [4]", "672"),
    ("1 [4]", "1 [2]", "538"),
    ("2 [0]", "2 [1]", "61441"),
    ("1 [0]", "0 [0]", "160"),
    ("3 [0]", "2 [0]", "240"),
    ("3 [0]", "2 [1]", "Error: Insufficient data: need bytes 3 to 4, but only 4 bytes available in DDT string"),
    ("4 [0]", "0 [1]", "Error: Byte 4 not available in DDT string"),
    ("0 [0]", "1 [1]", "Error: Cannot expand backward beyond byte 0"),
    ("0 [6]", "0 [3]", "Error: Invalid bit range: start=6, count=3"),
]


def test_worked_examples(spark):
    entries = [(b, f"f{i}", s, "I", "-", str(100 + i)) for i, (b, s, _) in enumerate(CASES)]
    got = decode_values(spark, codec_from_rows(spark, entries), [MSG])[MSG]
    assert [v for _, v, _ in got] == [e for _, _, e in CASES]


def test_non_hex_and_wide(spark):
    entries = [("1 [0]", "a", "1 [0]", "I", "-", "1"), ("0 [0]", "b", "1 [0]", "I", "-", "2"),
               ("0 [0]", "c", "8 [0]", "I", "-", "3")]
    got = decode_values(spark, codec_from_rows(spark, entries), ["62ZZ01F0FFFFFFFFFFFFFFFF"])
    vals = [v for _, v, _ in got["62ZZ01F0FFFFFFFFFFFFFFFF"]]
    assert vals[0] == "Error: invalid literal for int() with base 16: 'ZZ'"
    assert vals[1] == "98"
    assert vals[2].startswith("Error: invalid literal")  # the 8-byte slice holds 'ZZ'


def test_last_description_wins_keeps_first_place(spark):
    entries = [("0 [0]", "Reserved", "1 [0]", "I", "-", "1"), ("1 [0]", "x", "1 [0]", "I", "-", "2"),
               ("2 [0]", "Reserved", "1 [0]", "I", "-", "3")]
    got = decode_values(spark, codec_from_rows(spark, entries), ["62A001"])["62A001"]
    assert got[0][0] == "Reserved" and got[0][1] == "1"  # byte 2 value, first position
    assert [d for d, _, _ in got] == ["Reserved", "x"]


def test_table_field_without_a_table_file(spark):
    entries = [("0 [0]", "SID-PR", "1 [0]", "-", "-", "-"), ("1 [0]", "RecordDataIdentifier", "2 [0]", "-", "-", "-"),
               ("3 [0]", "Latest start cause", "1 [0]", "T", "Start Causes", "7105")]
    m = "62B3101F00FF"
    got = decode_values(spark, codec_from_rows(spark, entries), [m])[m]
    assert got[0][1] == "98" and got[1][1] == "45840"
    assert got[2][1] == "0x1F" and got[2][2] == 31  # no table file: 0x%X, raw kept


def test_wide_fields_never_end_the_job(spark):
    entries = [("0 [0]", f"be{n}", f"{n} [0]", "I", "-", str(n)) for n in (7, 8, 9, 16)]
    entries += [("1 [0]", f"le{n}", f"{n} [1]", "I", "-", str(100 + n)) for n in (6, 7, 8, 9)]
    entries += [("1 [3]", "le6s", "6 [2]", "I", "-", "200"), ("-1 [0]", "neg", "0 [3]", "I", "-", "300")]
    low, high = "00" * 9 + "0102030405060708", "FF" * 17
    got = decode_values(spark, codec_from_rows(spark, entries), [low, high])
    v = {d: x for d, x, _ in got[high]}
    assert v["be7"] == str(2**56 - 1) and v["le6"] == str(2**49 - 1) and v["le7"] == str(2**57 - 1)
    for d, bits in (("be8", 64), ("be9", 72), ("be16", 128)):
        assert v[d] == f"Error: field of {bits} bits is wider than 63 bits"
    assert all(v[d].startswith("Error: field of") for d in ("le8", "le9"))
    assert v["le6s"] == str(2**50 - 1)
    v = {d: x for d, x, _ in got[low]}
    assert v["be8"] == v["be9"] == "0" and v["be16"] == str(0x01020304050607)  # leading zeros do not count


def test_quick_and_full_rules_agree(spark):
    """The read plan against the rules in full, over positions, sizes and message lengths."""
    import random

    from pyspark.sql import functions as F

    from telemsg.functions.hexbits import extract_field, fast_raw, read_plan, reversed_bytes

    rng = random.Random(4)
    rows = []
    for _ in range(3000):
        m = "".join(rng.choices("0123456789ABCDEFabcdef", k=rng.randint(0, 24)))
        rows.append((m, rng.randint(-1, 10), rng.randint(-1, 8), rng.randint(0, 8), rng.randint(0, 9)))
    df = spark.createDataFrame(rows, "m string, b int, t int, n int, k int")
    m, b, t, n, k = (F.col(c) for c in "mbtnk")
    df = df.withColumn("x", extract_field(m, F.length(m), F.lit(True), b, t, n, k)).withColumn("p", read_plan(b, t, n, k))
    nb = F.shiftright(F.length(m), 1)
    use = F.col("p.ok") & (F.col("p.need") <= nb)
    df = df.withColumn("q", F.when(use, fast_raw(m, reversed_bytes(m), nb, F.col("p"))))
    got = df.where("q is not null").select("m", "b", "t", "n", "k", "x.raw", "x.err", "q").collect()
    assert len(got) > 300
    assert [r for r in got if r.err is not None or r.raw != r.q] == []
