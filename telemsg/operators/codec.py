"""Codec dimension (D0, D1): one row per (family, year, msg) holding the ordered
array of fields to decode, with the linear and table conversion rules of every
field already resolved. Spark builds it from the layout and conversion files; ``plans.batch.write_dimension`` keeps
it as a table, which a decode joins by key, so decoding needs no per-row lookup and no Python.

Field struct:
  ord, description, raw_position, size, type, name, id      layout entry
  b, t, n, k                                                 byte, bit, bytes, bits
  id_int                                                     id as integer (null if not one)
  plan  how to read the field's bits (functions/hexbits.read_plan)
  lin   struct<factor, offset, decimals, raw_max, encodings> first linear row of the id
        (null when the table has no row for the id)
  labels map<raw value, label>                               table rows of the id

Conversion rows belong to their file, so their key is (family, year, ecu, id).

Only the last entry of a repeated description is kept (later entries overwrite
earlier ones in the decoded result); fields keep the position of their first entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemsg.functions.hexbits import read_plan
from telemsg.sources.conversions import na_to_null

INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
HEX_TEXT = r"^(0[xX])?[0-9A-Fa-f]+$"


def parse_position(text: Column, default: str):
    """``"3 [4]"`` -> (3, 4); a missing bracket part gives 0.
    Returns (major, minor, ok) columns; ok is false when a part is not an integer."""
    t = F.coalesce(text, F.lit(default))
    parts = F.split(F.trim(t), r"\s+")
    major = F.get(parts, 0).try_cast("int")
    second = F.get(parts, 1)
    has_minor = second.isNotNull() & second.contains("[")
    minor_txt = F.regexp_replace(second, r"^[\[\]]+|[\[\]]+$", "")
    minor = F.when(has_minor, minor_txt.try_cast("int")).otherwise(F.lit(0))
    ok = major.isNotNull() & minor.isNotNull()
    return major, minor, ok


def _hex_value(text: Column) -> Column:
    s = F.trim(F.regexp_replace(text, r"\$", ""))
    s = F.regexp_replace(s, r"^0[xX]", "")
    return F.when(s.rlike(r"^[0-9A-Fa-f]{1,15}$"), F.conv(s, 16, 10).try_cast("bigint"))


def linear_rules(linear: DataFrame) -> DataFrame:
    """(family, year, ecu, id_int, lin) from the linear rows; first row by file order is the base. An encoding
    with one text matches a raw value only where the text is that value's ``$%02X``."""
    raw_min = F.trim(na_to_null("Raw Min"))
    raw_max = F.trim(na_to_null("Raw Max"))
    label = na_to_null("Encoding Name")
    num = lambda c: F.coalesce(na_to_null(c).try_cast("double"), F.lit(float("nan")))
    dec = na_to_null("Decimal Places").try_cast("double")
    dec = F.when(dec.isNull() | F.isnan(dec) | (F.abs(dec) == float("inf")), 0.0).otherwise(dec)
    max_val = F.when(raw_max.startswith("$"), _hex_value(raw_max)).otherwise(
        F.when(raw_max.rlike(r"^[+-]?[0-9]{1,18}$"), raw_max.try_cast("bigint"))
    )
    single = raw_min.isNotNull() & (raw_min == raw_max)
    rng = (F.coalesce(raw_min, F.lit("")) != "") & (F.coalesce(raw_max, F.lit("")) != "") & (raw_min != raw_max)
    lo, hi = _hex_value(raw_min), _hex_value(raw_max)
    exact = F.coalesce(single & (F.format_string("$%02X", lo) == raw_min), F.lit(False))
    enc = F.when(
        label.isNotNull() & (exact | (rng & lo.isNotNull() & hi.isNotNull())),
        F.struct(F.col("ord"), lo.alias("lo"), hi.alias("hi"), label.alias("label")),
    )
    rows = linear.select(
        "family",
        "year",
        "ecu",
        F.col("ID").try_cast("bigint").alias("id_int"),
        F.struct(
            F.col("ord"),
            num("Factor (m)").alias("factor"),
            num("Offset (b)").alias("offset"),
            dec.cast("int").alias("decimals"),
            max_val.alias("raw_max"),
            na_to_null("Units").alias("units"),
        ).alias("row"),
        enc.alias("enc"),
    ).filter(F.col("id_int").isNotNull())
    grouped = rows.groupBy("family", "year", "ecu", "id_int").agg(
        F.min_by("row", F.col("row.ord")).alias("base"),
        F.array_sort(F.collect_list("enc")).alias("encodings"),
    )
    return grouped.select(
        "family",
        "year",
        "ecu",
        "id_int",
        F.struct(
            F.col("base.factor").alias("factor"),
            F.col("base.offset").alias("offset"),
            F.col("base.decimals").alias("decimals"),
            F.col("base.raw_max").alias("raw_max"),
            F.col("base.units").alias("units"),
            F.transform("encodings", lambda e: e.dropFields("ord")).alias("encodings"),
        ).alias("lin"),
    )


def table_rules(table: DataFrame) -> DataFrame:
    """(family, year, ecu, id_int, labels): raw value -> label. A row's trimmed ``Min`` text stands for the value
    whose ``$%X`` it is, or else whose ``$%02X``; of equal texts the first row wins. Other texts match nothing."""
    text = F.trim(na_to_null("Min"))
    value = F.when(text.rlike(r"^\$[0-9A-F]{1,15}$"), F.conv(F.substr(text, F.lit(2)), 16, 10).cast("bigint"))
    rank = F.when(text == F.format_string("$%X", value), 0).when(text == F.format_string("$%02X", value), 1)
    rows = table.select(
        "family",
        "year",
        "ecu",
        F.col("ID").try_cast("bigint").alias("id_int"),
        value.alias("raw"),
        F.struct(rank.alias("rank"), "ord").alias("order"),
        F.coalesce(na_to_null("Encoding Name"), F.lit("NaN")).alias("label"),
    ).filter(F.col("id_int").isNotNull() & F.col("order.rank").isNotNull())
    first = rows.groupBy("family", "year", "ecu", "id_int", "raw").agg(F.min_by("label", "order").alias("label"))
    return first.groupBy("family", "year", "ecu", "id_int").agg(
        F.map_from_entries(F.collect_list(F.struct("raw", "label"))).alias("labels")
    )


def build_codec(
    layouts: DataFrame,
    linear: DataFrame,
    table: DataFrame,
    family_years: DataFrame | None = None,
    descriptions: DataFrame | None = None,
) -> DataFrame:
    """Codec rows (family, year, msg, layout_name, has_linear, has_table, broken, fields).

    ``family_years`` (family, year) restricts the codec to configured combinations.
    ``descriptions`` (msg, description) restricts fields to the ones an output
    needs; the result is the same for those fields, only cheaper to decode.
    """
    if family_years is not None:
        fy = family_years.select("family", "year").distinct()
        layouts = layouts.join(fy, ["family", "year"], "left_semi")
        linear = linear.join(fy, ["family", "year"], "left_semi")
        table = table.join(fy, ["family", "year"], "left_semi")

    b, t, ok1 = parse_position(F.col("byte"), "0 [0]")
    n, k, ok2 = parse_position(F.col("size"), "1 [0]")
    desc = F.coalesce(F.col("description"), F.lit("Unknown"))
    entries = layouts.select(
        "family", "year", "ecu", "msg", "layout_name", "ord",
        desc.alias("description"),
        F.coalesce("byte", F.lit("0 [0]")).alias("raw_position"),
        F.coalesce("size", F.lit("1 [0]")).alias("size"),
        F.coalesce("type", F.lit("")).alias("type"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.col("id"),
        b.alias("b"), t.alias("t"), n.alias("n"), k.alias("k"),
        (ok1 & ok2).alias("pos_ok"),
        F.when(F.col("id").rlike(INT_TEXT), F.trim("id").try_cast("bigint")).alias("id_int"),
    )
    key = ["family", "year", "msg"]
    file_key = ["family", "year", "ecu"]
    lin, tab = linear_rules(linear), table_rules(table)  # the planner sizes these joins
    has_lin = linear.select(*file_key).distinct().withColumn("has_linear", F.lit(True))
    has_tab = table.select(*file_key).distinct().withColumn("has_table", F.lit(True))

    field = F.struct(
        F.col("ord"), "description", "raw_position", "size", "type", "name", "id",
        "b", "t", "n", "k", "id_int", "plan",
        F.when(F.col("type") == "L", F.col("lin")).alias("lin"),
        F.when(F.col("type") == "T", F.coalesce("labels", F.create_map().cast("map<bigint,string>"))).alias("labels"),
    )
    per_msg = (
        entries.withColumn("plan", read_plan(F.col("b"), F.col("t"), F.col("n"), F.col("k")))
        .join(lin, [*file_key, "id_int"], "left")
        .join(tab, [*file_key, "id_int"], "left")
        .groupBy(*key)
        .agg(
            F.collect_list(field).alias("all_fields"),
            # a position that cannot be parsed fails the whole message, as in the reference
            F.bool_or(~F.col("pos_ok")).alias("broken"),
            F.first("layout_name").alias("layout_name"),
            F.first("ecu").alias("ecu"),
        )
    )
    # last entry of each description wins; it keeps the place of the first entry
    last = F.filter(
        "all_fields",
        lambda x: ~F.exists(
            "all_fields", lambda y: (y["description"] == x["description"]) & (y["ord"] > x["ord"])
        ),
    )
    placed = F.transform(
        last,
        lambda x: x.withField(
            "ord",
            F.array_min(
                F.transform(F.filter("all_fields", lambda y: y["description"] == x["description"]), lambda y: y["ord"])
            ),
        ),
    )
    out = per_msg.withColumn("fields", sort_by_ord(placed)).drop("all_fields")
    if descriptions is not None:
        wanted = descriptions.groupBy("msg").agg(F.collect_set("description").alias("_wanted"))
        out = out.join(wanted, "msg", "left").withColumn(
            "fields", F.filter("fields", lambda f: F.array_contains(F.coalesce("_wanted", F.array().cast("array<string>")), f["description"]))
        ).drop("_wanted")
    return (
        out.join(has_lin, file_key, "left")
        .join(has_tab, file_key, "left")
        .select(
            *key,
            "layout_name",
            F.coalesce("has_linear", F.lit(False)).alias("has_linear"),
            F.coalesce("has_table", F.lit(False)).alias("has_table"),
            F.col("broken"),
            F.col("fields"),
        )
    )


def sort_by_ord(arr: Column) -> Column:
    """Sort an array of structs by their ``ord`` field (structs holding maps are
    not orderable as a whole)."""
    return F.array_sort(
        arr, lambda x, y: F.when(x["ord"] < y["ord"], -1).when(x["ord"] > y["ord"], 1).otherwise(0)
    )


def load_codec(spark, root: str, catalogue=None, declared_only: bool = False) -> DataFrame:
    """Read layouts and conversion tables under ``root`` and build the codec.
    With a catalogue, only its (family, year) combinations are kept, and with
    ``declared_only`` only the fields its output columns name."""
    from telemsg.catalogue import local_rows
    from telemsg.sources.conversions import read_layouts, read_linear, read_table

    fy = None
    descs = None
    layouts = read_layouts(spark, root)
    if catalogue is not None:
        fy = local_rows(spark, catalogue.family_years(), "family string, year int")
        ecus = local_rows(spark, [(m.msg, m.ecu) for m in catalogue.messages], "msg string, ecu string")
        layouts = layouts.join(ecus, ["msg", "ecu"], "left_semi")
        if declared_only:
            descs = catalogue.output_columns_df(spark).select("msg", "description")
    return build_codec(layouts, read_linear(spark, root), read_table(spark, root), fy, descs)


def align_codec(codec: DataFrame, catalogue) -> DataFrame:
    """Codec whose fields are the catalogue's declared fields of each message, in
    declared order (a declared description missing from the layout gives a null
    element), so typed column j of a message is decoded element j."""
    arrays = None
    for m in catalogue.messages:
        lit = F.array(*[F.lit(c.description) for c in m.columns]) if m.columns else F.array().cast("array<string>")
        arrays = (F.when(F.col("msg") == m.msg, lit) if arrays is None else arrays.when(F.col("msg") == m.msg, lit))
    if arrays is None:
        return codec
    aligned = F.transform(
        arrays.otherwise(F.array().cast("array<string>")),
        lambda d: F.get(F.filter("fields", lambda f: f["description"] == d), 0),
    )
    return codec.withColumn("fields", aligned)
