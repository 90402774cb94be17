"""A made-up message with fields of 8, 9 and 16 bytes: its layout, its conversion rows and its stand-in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.catalogue import local_rows
from telemsg.operators.codec import build_codec
from telemsg.sources.conversions import LINEAR_COLUMNS, TABLE_COLUMNS

MSG, BYTES = "D0E0", 26
#: (byte, description, size, type, id): numbers of 64 bits and more, whole bytes and bytes with bits beside.
ENTRIES = [
    ("2 [0]", "Eight", "8 [0]", "I", "9"), ("2 [0]", "Nine", "9 [0]", "I", "9"), ("2 [0]", "Sixteen", "16 [0]", "I", "9"),
    ("10 [0]", "Eight and bits", "8 [4]", "I", "9"), ("10 [3]", "Nine, shifted", "9 [1]", "I", "9"),
    ("2 [0]", "Half", "8 [0]", "L", "1"), ("2 [0]", "Tenth", "8 [0]", "L", "2"), ("2 [0]", "Limited", "8 [0]", "L", "3"),
    ("2 [0]", "Listed", "8 [0]", "T", "4"),
]
LINEAR = [("1", "0.5", "0", "0", ""), ("2", "0.1", "0", "1", ""), ("3", "1", "0", "0", "$FFFE")]
TABLE = [("4", "$1", "One")]


def wide_codec(spark: SparkSession) -> DataFrame:
    """The message's codec row, as family WI of year 2025."""
    base = ("WI", 2025, "BCM")
    layout = local_rows(
        spark, [(*base, MSG, "wide", i, b, d, s, t, d, x, None) for i, (b, d, s, t, x) in enumerate(ENTRIES)],
        "family string, year int, ecu string, msg string, layout_name string, ord long, byte string, description string, "
        "size string, type string, name string, id string, default_value string",
    )

    def rows(cells: list[dict], columns: list[str]) -> DataFrame:
        plain = [f"c{i}" for i in range(len(columns))]
        ddl = "family string, year int, ecu string, ord long, " + ", ".join(f"{c} string" for c in plain)
        df = local_rows(spark, [(*base, i, *[r.get(c, "") for c in columns]) for i, r in enumerate(cells)], ddl)
        return df.withColumnsRenamed(dict(zip(plain, columns, strict=True)))

    linear = [dict(zip(("ID", "Factor (m)", "Offset (b)", "Decimal Places", "Raw Max"), r, strict=True)) for r in LINEAR]
    table = [dict(zip(("ID", "Min", "Encoding Name"), r, strict=True)) for r in TABLE]
    return build_codec(layout, rows(linear, LINEAR_COLUMNS), rows(table, TABLE_COLUMNS))


def wide_message(event: Column, user: Column) -> Column:
    """The message's text from an event's numbers."""
    words = [(event * m + user * 7919 + 12345 * i) % 2**32 for i, m in enumerate((2654435761, 40503, 977, 69069, 1103515245, 22695477))]
    return F.format_string("D0E0" + "%08X" * 6, *[w.cast("bigint") for w in words])
