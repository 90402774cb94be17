"""Message decode (D2-D13) as native Spark expressions.

``decode_fields`` maps a message and its codec row to an array of decoded field
structs with one ``F.transform``, in which each field's raw value and conversion
are computed once. No explode, no shuffle, no Python: the per-row work
stays in the JVM, and the codec arrives by a broadcast join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemsg.functions.convert import convert_field, error_value, raw_value_of, value_text
from telemsg.functions.hexbits import extract_field, fast_raw, is_all_hex, reversed_bytes

EMPTY_MESSAGE = '{"error":"Empty DDT string"}'  # fixed value

DECODED_FIELD = (
    "struct<description:string,decoded_value:string,raw_position:string,size:string,"
    "msg_type:string,msg_id:string,raw_value:bigint,raw_wide:string>"
)


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def decode_fields(msg: Column, codec: Column, slim: bool = False) -> Column:
    """array<DECODED_FIELD> in codec field order, or null when the message is
    null or the codec is missing or broken. Null codec fields (declared but
    absent from the layout) give null elements. With ``slim`` the elements are
    the values alone (label, whole number or float), enough for typed columns.

    What is the same for all fields of a message - its length, whether it is hex, its reversed text - is bound once
    as a lambda variable. As a column it could be moved into the field loop by the optimizer and run for each field.
    """
    per_message = F.struct(
        msg.alias("msg"),
        F.length(msg).alias("length"),
        is_all_hex(msg).alias("all_hex"),
        reversed_bytes(msg).alias("rev"),
        codec["has_linear"].alias("has_linear"),
        codec["has_table"].alias("has_table"),
        codec["fields"].alias("fields"),
    )

    def per_row(r: Column) -> Column:
        n_bytes = F.shiftright(r["length"], 1)

        def shape(f: Column, raw: Column, value: Column) -> Column:
            return F.struct(
                f["description"].alias("description"),
                value_text(value).alias("decoded_value"),
                f["raw_position"].alias("raw_position"),
                f["size"].alias("size"),
                f["type"].alias("msg_type"),
                f["id"].alias("msg_id"),
                raw_value_of(f, raw, value, r["has_linear"]).alias("raw_value"),
                F.lit(None).cast("string").alias("raw_wide"),  # set by a compiled codec, for 2^63 and more
            )

        # raw value and conversion are bound in turn; the field itself is never carried, as results are copied
        def per_field(f: Column) -> Column:
            full = extract_field(r["msg"], r["length"], r["all_hex"], f["b"], f["t"], f["n"], f["k"])
            quick = r["all_hex"] & f["plan"]["ok"] & (f["plan"]["need"] <= n_bytes)
            raw = F.when(quick, fast_raw(r["msg"], r["rev"], n_bytes, f["plan"])).otherwise(full["raw"])

            def converted(raw: Column) -> Column:
                value = F.when(raw.isNotNull(), convert_field(f, raw, r["has_linear"], r["has_table"])).otherwise(
                    error_value(full["err"])
                )
                return value if slim else bound(value, lambda v: shape(f, raw, v))

            return F.when(f.isNotNull(), bound(raw, converted))

        return F.transform(r["fields"], per_field)

    decoded = bound(per_message, per_row)
    return F.when(msg.isNotNull() & codec.isNotNull() & ~F.coalesce(codec["broken"], F.lit(False)), decoded)


def decode(
    df: DataFrame,
    msg_col: str,
    codec_col: str,
    out_col: str,
    valid_col: str | None = None,
    slim: bool = False,
) -> DataFrame:
    """Add ``out_col`` = decoded fields of ``msg_col`` using the codec struct in
    ``codec_col``; with ``valid_col`` only valid messages are decoded (D13)."""
    out = decode_fields(F.col(msg_col), F.col(codec_col), slim=slim)
    if valid_col is not None:
        out = F.when(F.col(valid_col), out)
    return df.withColumn(out_col, out)


def field_rows(df: DataFrame, keys: list[str], decoded_col: str) -> DataFrame:
    """One row per decoded field: (keys, field_index, f). The outer explode with a filter after it, as a plain
    explode makes the optimizer infer a filter on the array below it, which would decode each message once more."""
    rows = df.select(*keys, F.posexplode_outer(decoded_col).alias("field_index", "f"))
    return rows.where(F.col("field_index").isNotNull())


def decoded_map(decoded: Column) -> Column:
    """map<description, field struct> (descriptions are unique in a codec)."""
    return F.map_from_arrays(F.transform(decoded, lambda x: x["description"]), decoded)


def decoded_json(
    decoded: Column,
    msg: Column,
    codec: Column,
    family: Column,
    year: Column,
    msg_code: str | Column,
    on_error: str = "null",
    on_empty: str = "null",
) -> Column:
    """The decoded message as one JSON document:
    {code, name, decoded_values: {description: {...}}, vehicle_family, model_year, ddt_type}.
    Decoded values are JSON strings here (numbers are quoted).

    D11: with ``on_error="object"`` a message that cannot be decoded - its layout is missing, or a position in it is
    no number - gives {error, ddt_type, family, year}; with "null" nothing. D12: with ``on_empty="object"`` a null or
    empty message gives {"error": "Empty DDT string"}; with "null" nothing."""
    code = msg_code if isinstance(msg_code, Column) else F.lit(msg_code)
    document = F.to_json(
        F.struct(
            msg.alias("code"),
            F.coalesce(codec["layout_name"], F.lit("Unknown")).alias("name"),
            decoded_map(decoded).alias("decoded_values"),
            family.alias("vehicle_family"),
            year.alias("model_year"),
            code.alias("ddt_type"),
        )
    )
    out = F.when(decoded.isNotNull(), document)
    if on_error == "object":
        problem = F.when(codec.isNull(), F.lit("Structure file not found")).otherwise(F.lit("Invalid position in the structure"))
        failed = F.struct(problem.alias("error"), code.alias("ddt_type"), family.alias("family"), year.alias("year"))
        bad = codec.isNull() | F.coalesce(codec["broken"], F.lit(False))
        out = F.coalesce(out, F.when(msg.isNotNull() & (msg != "") & bad, F.to_json(failed)))
    if on_empty == "object":
        out = F.when(msg.isNull() | (msg == ""), F.lit(EMPTY_MESSAGE)).otherwise(out)
    return out
