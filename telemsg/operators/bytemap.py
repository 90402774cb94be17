"""Byte map of decoded messages (D14, the message interrogator as a Spark job).

Two views of the same decode:

* ``field_map``: one row per (message row, field): index, description, position,
  size, the hex text the field covers, its binary text, value and raw value;
* ``byte_map``: one row per (message row, byte): hex, binary, and the list of
  fields that read the byte.

Both are ``posexplode``s of per-row arrays, so they grow linearly with the data
and need no shuffle except the grouping by byte, which is keyed by row and byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemsg.operators.codec import parse_position
from telemsg.operators.decode import field_rows


def _binary(hex_text):
    """Four bits a digit, of any length; null where nothing is covered or a character is no hex digit."""
    bits = F.transform(F.split(hex_text, ""), lambda c: F.lpad(F.conv(c, 16, 2), 4, "0"))
    return F.when(hex_text.rlike("^[0-9A-Fa-f]+$"), F.array_join(bits, ""))


def field_map(df: DataFrame, row_id: str, msg_col: str, decoded_col: str) -> DataFrame:
    """(row_id, field_index, description, raw_position, size, first_byte, last_byte,
    covered_hex, covered_binary, decoded_value, raw_value)."""
    x = field_rows(df, [row_id, msg_col], decoded_col)
    b, t, _ = parse_position(F.col("f.raw_position"), "0 [0]")
    n, k, _ = parse_position(F.col("f.size"), "1 [0]")
    mixed, plain = (n > 0) & (k > 0), (n == 0) & (k == 0)
    n_bytes = F.shiftright(F.length(msg_col), 1)
    # the bits below byte 0 do not exist; a little-endian read with a bit offset also takes the next byte, if any
    first = F.when(mixed, F.greatest(b - 1, F.lit(0))).otherwise(b)
    last = F.when(n > 0, b + n - 1).otherwise(b)
    last = F.when((mixed | plain) & (t > 0) & (last + 1 < n_bytes), last + 1).otherwise(last)
    covered = F.col(msg_col).substr(first * 2 + 1, (last - first + 1) * 2)
    return x.select(
        row_id,
        "field_index",
        F.col("f.description").alias("description"),
        F.col("f.raw_position").alias("raw_position"),
        F.col("f.size").alias("size"),
        first.alias("first_byte"),
        last.alias("last_byte"),
        covered.alias("covered_hex"),
        _binary(covered).alias("covered_binary"),
        F.col("f.decoded_value").alias("decoded_value"),
        F.col("f.raw_value").alias("raw_value"),
    )


def byte_map(df: DataFrame, row_id: str, msg_col: str, decoded_col: str) -> DataFrame:
    """(row_id, byte, hex, binary, fields): fields = descriptions reading the byte,
    in field order."""
    fm = field_map(df, row_id, msg_col, decoded_col).select(
        row_id, "field_index", "description", F.explode(F.sequence("first_byte", "last_byte")).alias("byte")
    )
    readers = fm.groupBy(row_id, "byte").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("field_index", "description"))), lambda s: s["description"]
        ).alias("fields")
    )
    nbytes = df.select(row_id, msg_col).select(
        row_id, msg_col, F.explode(F.sequence(F.lit(0), F.floor(F.length(msg_col) / 2).cast("int") - 1)).alias("byte")
    ).filter(F.col("byte") >= 0)
    hexes = nbytes.select(
        row_id, "byte", F.col(msg_col).substr(F.col("byte") * 2 + 1, F.lit(2)).alias("hex")
    ).withColumn("binary", _binary(F.col("hex")))
    return hexes.join(readers, [row_id, "byte"], "left").withColumn(
        "fields", F.coalesce("fields", F.array().cast("array<string>"))
    )
