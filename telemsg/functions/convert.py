"""Conversion of extracted raw integers to decoded values.

Decoded values are text, in the form the reference's JSON carries them: an
integer prints as digits, a rounded float as Python's ``repr``, a label as is.
All builders take Columns, so they run inside ``F.transform`` over codec fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemsg.functions.numeric import numpy_round, python_float_text

# Labels of the special raw values (fixed values of the conversion rules).
INVALID_NOT_AVAILABLE = "Invalid/Not Available"
INVALID_SENSOR_ERROR = "Invalid/Sensor Error"
NOT_INITIALIZED = "Not Initialized"
OUT_OF_RANGE = "Out of Range/Invalid"

# Entry-name fallbacks for table fields without a matching row (fixed values):
# substring of the entry name -> (label for raw 1, label otherwise)
NAME_FALLBACKS = [
    ("Present/Not present", "Present", "Not present"),
    ("Fault/No Fault", "Fault", "No Fault"),
    ("False / True", "True", "False"),
]

BAD_INT_ID = "invalid literal for int() with base 10: '%s'"


def special_value(raw: Column, raw_max: Column) -> Column:
    """Label for diagnostic special values judged against the first row's Raw Max, or null."""
    return (
        F.when(raw_max.isNull(), F.lit(None).cast("string"))
        .when(
            raw == 0xFFFF,
            F.when(raw_max == 0xFFFE, F.lit(INVALID_NOT_AVAILABLE)).when(
                raw_max < 0xFFFF, F.lit(INVALID_SENSOR_ERROR)
            ),
        )
        .when((raw == 0xFFFE) & (raw_max < 0xFFFE), F.lit(NOT_INITIALIZED))
        .when(raw > raw_max, F.lit(OUT_OF_RANGE))
    )


def encoding_label(raw: Column, encodings: Column) -> Column:
    """Label of the first encoding (file order) whose range holds raw; single texts are ranges of one value."""
    return F.get(F.filter(encodings, lambda e: (e["lo"] <= raw) & (raw <= e["hi"])), 0)["label"]


VALUE = "struct<text:string,whole:bigint,num:double>"


def value_of(text: Column | None = None, whole: Column | None = None, num: Column | None = None) -> Column:
    """A decoded value: a label, a whole number or a rounded float; at most one is set. The number's text is made
    only where text is asked for (``value_text``)."""
    return F.struct(
        (F.lit(None) if text is None else text).cast("string").alias("text"),
        (F.lit(None) if whole is None else whole).cast("bigint").alias("whole"),
        (F.lit(None) if num is None else num).cast("double").alias("num"),
    )


def value_text(v: Column) -> Column:
    """The value as the reference's JSON carries it."""
    return F.coalesce(v["text"], v["whole"].cast("string"), python_float_text(v["num"]))


def linear_value(raw: Column, lin: Column) -> Column:
    """Value of a linear field with a conversion row (``lin`` not null)."""
    x = raw.cast("double") * lin["factor"] + lin["offset"]
    label = F.coalesce(
        F.when(F.size(lin["encodings"]) > 0, encoding_label(raw, lin["encodings"])),
        special_value(raw, lin["raw_max"]),
    )
    bad = (
        F.when(lin["decimals"] > 0, F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("Conv Error: cannot convert float NaN to integer"))
        .when(F.abs(x) == float("inf"), F.lit("Error: cannot convert float infinity to integer"))
    )
    return value_of(
        F.coalesce(label, bad),
        F.when(label.isNull() & (lin["decimals"] <= 0) & bad.isNull(), x.try_cast("bigint")),
        F.when(label.isNull() & (lin["decimals"] > 0), numpy_round(x, lin["decimals"])),
    )


def table_value(raw: Column, labels: Column, name: Column) -> Column:
    """Text of a table field whose table exists and whose id is an integer. ``labels`` is keyed by the raw value."""
    fallback = F.format_string("0x%X (No match)", raw)
    for needle, yes, no in reversed(NAME_FALLBACKS):
        fallback = F.when(name.contains(needle), F.when(raw == 1, F.lit(yes)).otherwise(F.lit(no))).otherwise(
            fallback
        )
    return F.coalesce(labels[raw], fallback)


def error_value(err: Column) -> Column:
    """Value of a field that could not be read."""
    return value_of(F.concat(F.lit("Error: "), err))


def convert_field(f: Column, raw: Column, has_linear: Column, has_table: Column) -> Column:
    """VALUE of one field whose raw value (not null) was read."""
    has_id = f["id"].isNotNull()
    bad_id = F.format_string(BAD_INT_ID, f["id"])
    plain = value_of(whole=raw)
    linear = (
        F.when(f["lin"].isNotNull() & has_linear, linear_value(raw, f["lin"]))
        .when(has_id & has_linear & f["id_int"].isNull(), value_of(F.concat(F.lit("Conv Error: "), bad_id)))
        .otherwise(plain)
    )
    table = (
        F.when(has_id & has_table & f["id_int"].isNull(), F.format_string("0x%X (Conv Error: %s)", raw, bad_id))
        .when(has_id & has_table, table_value(raw, f["labels"], f["name"]))
        .otherwise(F.format_string("0x%X", raw))
    )
    return F.when(f["type"] == "L", linear).when(f["type"] == "T", value_of(table)).otherwise(plain)


def raw_value_of(f: Column, raw: Column, value: Column, has_linear: Column) -> Column:
    """The raw value shown beside a decoded one: of linear fields with a linear file and of table fields, both with an
    id; none for a table label that begins with ``Error``."""
    is_t = f["type"] == "T"
    hidden = is_t & F.coalesce(value["text"].startswith("Error"), F.lit(False))
    return F.when(f["id"].isNotNull() & (((f["type"] == "L") & has_linear) | is_t) & ~hidden, raw)
