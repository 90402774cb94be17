"""Decoded fields -> typed columns.

Casts use ``try_cast``: a label such as ``Out of Range/Invalid`` in a numeric
column becomes null, as a lenient cast would give (plain ``cast`` raises under
ANSI mode). All columns are added in one ``select`` to keep the plan shallow.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemsg.catalogue import TYPE_NAMES, MessageSpec
from telemsg.functions.convert import value_text

DECODED_VALUES_SCHEMA = T.StructType(
    [T.StructField("decoded_values", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))]
)


def field_value(decoded: Column, description: str) -> Column:
    """decoded_value of the field with this description (null when absent)."""
    return F.get(F.filter(decoded, lambda x: x["description"] == F.lit(description)), 0)["decoded_value"]


def typed_columns(decoded_col: str, spec: MessageSpec, aligned: bool = True, slim: bool = False) -> list[Column]:
    """One ``{msg}_{clean_name}`` column per declared field.
    With ``aligned`` the decoded array holds the declared fields in declared
    order (codec built with ``declared_only``), so column j is element j."""
    cols = []
    for j, c in enumerate(spec.columns):
        if slim:
            v = typed_value(F.get(F.col(decoded_col), j), c.spark_type)
        elif aligned:
            v = F.get(F.col(decoded_col), j)["decoded_value"].try_cast(c.spark_type)
        else:
            v = field_value(F.col(decoded_col), c.description).try_cast(c.spark_type)
        cols.append(v.alias(f"{spec.msg}_{c.clean_name}"))
    return cols


def typed_value(v: Column, spark_type: T.DataType) -> Column:
    """A value struct as the declared type; numbers do not pass through text, but where a float goes to another type."""
    if isinstance(spark_type, (T.FloatType, T.DoubleType)):
        return F.coalesce(v["num"].cast(spark_type), v["whole"].cast(spark_type), v["text"].try_cast(spark_type))
    if isinstance(spark_type, T.IntegralType):
        return F.coalesce(v["whole"].try_cast(spark_type), value_text(v).try_cast(spark_type))
    return value_text(v).try_cast(spark_type)


def flatten(
    df: DataFrame, specs: list[MessageSpec], decoded_suffix: str = "_decoded", aligned: bool = True, slim: bool = False
) -> DataFrame:
    extra = [c for s in specs for c in typed_columns(f"{s.msg}{decoded_suffix}", s, aligned, slim)]
    return df.select("*", *extra)


def parse_decoded_json(text: Column) -> Column:
    """JSON text of a decoded message -> struct<decoded_values: map<string, map<string,string>>>."""
    return F.from_json(text, DECODED_VALUES_SCHEMA)


def from_json_value(parsed: Column, description: str, type_name: str) -> Column:
    """X2 on parsed JSON: decoded_values[description].decoded_value as the declared type."""
    return parsed["decoded_values"][description]["decoded_value"].try_cast(TYPE_NAMES[type_name])


def clean_name(name: str) -> str:
    """Non-alphanumeric characters -> ``_``, then ``__`` -> ``_`` once."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name).replace("__", "_")


def columns_by_description(decoded_col: str, descriptions: list[str], prefix: str, skip_reserved: bool = True) -> list[Column]:
    """One text column per description, named by ``clean_name``."""
    out = []
    for d in descriptions:
        if skip_reserved and d == "Reserved":
            continue
        out.append(field_value(F.col(decoded_col), d).alias(clean_name(f"{prefix}_{d}")))
    return out


def columns_by_position(json_col: str, positions: dict[str, int], prefix: str, nested: bool = True) -> list[Column]:
    """One text column per description, read from its place in a JSON array of decoded fields (below
    ``decoded_values`` with ``nested``), named by ``clean_name``; null where the array is shorter."""
    head = "$.decoded_values" if nested else "$"
    return [
        F.get_json_object(json_col, f"{head}[{at}].decoded_value").alias(clean_name(f"{prefix}_{d}"))
        for d, at in sorted(positions.items())
    ]


def cast_by_patterns(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """cast columns by name pattern (exact name, or a trailing ``*`` for a
    prefix; the first matching pattern wins; a leading ``*`` is literal)."""
    def match(col: str) -> str | None:
        for p, t in patterns.items():
            if p.endswith("*") and col.startswith(p[:-1]):
                return t
            if col == p:
                return t
        return None

    sel = []
    for c in df.columns:
        t = match(c)
        sel.append(F.col(c).try_cast(TYPE_NAMES.get(t, t)).alias(c) if t else F.col(c))
    return df.select(*sel)


def bulk_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """cast the named columns (absent names are ignored) in one select."""
    sel = []
    for c in df.columns:
        t = types.get(c)
        if t is None:
            sel.append(F.col(c))
        elif t in ("timestamp",):
            sel.append(F.try_to_timestamp(F.col(c).cast("string")).alias(c) if not isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(c))
        else:
            sel.append(F.col(c).try_cast(TYPE_NAMES.get(t, t)).alias(c))
    return df.select(*sel)


def add_dt_if_missing(df: DataFrame, ts_col: str = "app_timestamp", fmt: str | None = None) -> DataFrame:
    """F16: add ``dt`` = date of the timestamp when the column is missing; text that is no date gives null."""
    if "dt" in df.columns:
        return df
    c = F.col(ts_col)
    if fmt is not None:
        return df.withColumn("dt", F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("date"))
    return df.withColumn("dt", c.try_cast("date"))
