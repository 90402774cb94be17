"""Build a codec from literal rows (layout entries, linear rows, table rows)."""
from telemsg.operators.codec import build_codec
from telemsg.sources.conversions import LINEAR_COLUMNS, TABLE_COLUMNS

LAYOUT_COLS = "family string, year int, ecu string, msg string, layout_name string, ord long, byte string, " \
              "description string, size string, type string, name string, id string, default_value string"


def codec_from_rows(spark, entries, linear=(), table=(), family="DT", year=2025, msg="M"):
    lay = spark.createDataFrame(
        [(family, year, "BCM", msg, "test", i, b, d, s, t, n, x, None) for i, (b, d, s, t, n, x) in enumerate(entries)],
        LAYOUT_COLS,
    )
    lin_schema = "family string, year int, ecu string, ord long, " + ", ".join(f"`{c}` string" for c in LINEAR_COLUMNS)
    lin = spark.createDataFrame([(family, year, "BCM", i, *r) for i, r in enumerate(linear)], lin_schema)
    tab_schema = "family string, year int, ecu string, ord long, " + ", ".join(f"`{c}` string" for c in TABLE_COLUMNS)
    tab = spark.createDataFrame([(family, year, "BCM", i, *r) for i, r in enumerate(table)], tab_schema)
    return build_codec(lay, lin, tab)


def decode_values(spark, codec, messages, msg="M"):
    """{message: [(description, decoded_value, raw_value), ...]} in field order."""
    from pyspark.sql import functions as F
    from telemsg.operators.decode import decode

    df = spark.createDataFrame([(m,) for m in messages], "m string").crossJoin(
        codec.filter(F.col("msg") == msg).select(F.struct("has_linear", "has_table", "broken", "fields", "layout_name").alias("codec"))
    )
    out = decode(df, "m", "codec", "d").select("m", "d").collect()
    return {r.m: [(x.description, x.decoded_value, x.raw_value) for x in (r.d or [])] for r in out}
