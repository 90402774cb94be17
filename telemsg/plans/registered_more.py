"""Further registered queries: sinks, filters, counts, JSON and map views, and the composed jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.operators.bytemap import byte_map, field_map
from telemsg.operators.decode import decoded_json
from telemsg.operators.flatten import (
    add_dt_if_missing, cast_by_patterns, columns_by_description, columns_by_position, from_json_value, parse_decoded_json,
)
from telemsg.operators.quality import (
    by_time, counts_by, decoding_summary, filter_counts, has_error, in_families, with_value,
)
from telemsg.operators.timeline import first_n_per_group
from telemsg.operators.union import drop_duplicate_rows, union_by_name
from telemsg.operators.validate import good_input_marker, length_filter, prepare_family
from telemsg.plans.batch import check_decode_family, decode_all_families, decode_family, merge_family_tables
from telemsg.plans.registered import MSG_COLS, _compiled, _decoded_rows, _joined
from telemsg.plans.sinks import read_merged, run_summary, shared_path, with_run_metadata, write_table
from telemsg.sample.standin import sample_catalogue, telemetry_from_events
from telemsg.sources.telemetry import read_table

TYPED = ["C1F0_supply_voltage", "C1F0_lamp_state", "C1F0_coolant_temp", "C1F0_trip_counter", "B310_latest_start_cause"]


def whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table by path, all its columns."""
    return read_table(spark, f"{sf_dir}/events.parquet")


def _halves(spark, sf_dir):
    j = _joined(spark, sf_dir)
    return (
        j.where("MODEL_YEAR = 2024").select("event_id", "MODEL_CODE"),
        j.where("MODEL_YEAR <> 2024").select("event_id", "MODEL_CODE", "tbm_keyon"),
    )


def overwritten_table(spark, sf_dir):
    """K1 + S9: an overwrite replaces data and schema; the table is read again."""
    a, b = _halves(spark, sf_dir)
    path = shared_path(spark, "overwritten")
    write_table(a, path, "overwrite")
    write_table(b, path, "overwrite")
    return read_table(spark, path)


def appended_table(spark, sf_dir):
    """K2: an append with a column more; the first rows have null there."""
    a, b = _halves(spark, sf_dir)
    path = shared_path(spark, "appended")
    write_table(a, path, "overwrite")
    write_table(b, path, "append")
    return read_merged(spark, path).select("event_id", "MODEL_CODE", "tbm_keyon")


def union_written(spark, sf_dir):
    """K3: union by name, then overwrite."""
    path = shared_path(spark, "union")
    write_table(union_by_name(list(_halves(spark, sf_dir))), path, "overwrite")
    return read_table(spark, path)


def run_metadata(spark, sf_dir):
    """K5: run columns on every row (the time as a flag, so that runs agree)."""
    out = with_run_metadata(_joined(spark, sf_dir).select("event_id"), "2", "7")
    return out.withColumn("processing_timestamp", F.col("processing_timestamp") <= F.current_timestamp())


def summary_table(spark, sf_dir):
    """K5: rows per family and year with the run's time."""
    out = run_summary(_joined(spark, sf_dir))
    return out.withColumn("processing_timestamp", F.col("processing_timestamp") <= F.current_timestamp())


def family_year_rows(spark, sf_dir):
    """one family and year."""
    return _joined(spark, sf_dir).where("MODEL_CODE = 'AU' AND MODEL_YEAR = 2025").select("event_id", "vin")


def named_families(spark, sf_dir):
    """membership in a list of families."""
    return in_families(_joined(spark, sf_dir), ["AU", "HO"]).select("event_id", "MODEL_CODE")


def present_messages(spark, sf_dir):
    """rows with a message."""
    return with_value(telemetry_from_events(spark, sf_dir), "diag_c1f0", "tbm_keyon").select("event_id")


def pattern_cast(spark, sf_dir):
    """casts by name pattern, first match wins."""
    t = telemetry_from_events(spark, sf_dir).select(
        "event_id", F.substring("diag_c1f0", 7, 4).alias("code_hex"), F.col("vin").alias("code_vin"),
        F.col("batteryvoltagelevel").cast("string").alias("volt"),
    )
    return cast_by_patterns(t, {"code_v*": "int", "code_*": "string", "volt": "float", "*lt": "int"})


def dt_added(spark, sf_dir):
    """F16: dt from the timestamp's text; text that is no date gives null."""
    t = telemetry_from_events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id") % 10 == 0, "soon").otherwise(F.col("app_timestamp")).alias("app_timestamp")
    )
    return add_dt_if_missing(t).select("event_id", "dt")


def sample_counts(spark, sf_dir):
    """A2: rows per family of the per-family sample (W2, a sampling operator)."""
    return counts_by(first_n_per_group(_joined(spark, sf_dir), 7, "MODEL_CODE", ["app_timestamp", "event_id"]), "MODEL_CODE")


def filter_effect(spark, sf_dir):
    """Rows before and after the validity filter, per family."""
    j = _joined(spark, sf_dir)
    return filter_counts(j, F.col("diag_c1f0").isNotNull() & (F.length("diag_c1f0") == 20), ["MODEL_CODE"])


def distinct_rows(spark, sf_dir):
    """U4: duplicates of a union dropped by key."""
    a = _joined(spark, sf_dir).select("event_id", "MODEL_CODE")
    return drop_duplicate_rows(union_by_name([a, a], allow_missing=False), ["event_id"])


def one_family(spark, sf_dir):
    """B1: decode of one family and year."""
    out = decode_family(_joined(spark, sf_dir), "AU", 2025, sample_catalogue(), _compiled(spark, True))
    return out.select("event_id", *TYPED)


def all_families(spark, sf_dir):
    """B2: decode of all families and years in one plan."""
    out = decode_all_families(_joined(spark, sf_dir), sample_catalogue(), _compiled(spark, True), how="any")
    return out.select("event_id", "MODEL_CODE", "MODEL_YEAR", *TYPED)


def prepared_family(spark, sf_dir):
    """one family's rows of the expected lengths."""
    cat = sample_catalogue()
    out = prepare_family(_joined(spark, sf_dir), "AU", 2025, cat.lengths_df(spark), list(MSG_COLS), MSG_COLS)
    return out.select("event_id", "MODEL_YEAR")


def flagged_rows(spark, sf_dir):
    """F8 without the filter: every row with its length flags; F17 on an alert without a check."""
    cat = sample_catalogue()
    out = length_filter(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS), MSG_COLS, filter_invalid=False)
    out = good_input_marker(out, ["C1F0", "A7"])
    return out.select("event_id", "all_ddt_lengths_valid", "goodDiagInput_C1F0", "goodDiagInput_A7")


def checked_family(spark, sf_dir):
    """Length check, decode, typed columns and sort of one family and year."""
    order = ["app_timestamp", "event_id"]
    out = check_decode_family(_joined(spark, sf_dir), "AU", 2025, sample_catalogue(), _compiled(spark, True), order)
    return out.select("event_id", "app_timestamp", *TYPED)


def merged_families(spark, sf_dir):
    """Family tables united, cast, dated, written and read."""
    j = _joined(spark, sf_dir)
    a = j.where("MODEL_CODE = 'AU'").select("event_id", "app_timestamp", F.col("batteryvoltagelevel").cast("string").alias("volt"))
    b = j.where("MODEL_CODE = 'BU'").select("event_id", "app_timestamp", "tbm_keyon")
    types = {"volt": "float", "absent": "int"}
    return merge_family_tables([a, b, a], types, shared_path(spark, "merged")).select("event_id", "volt", "tbm_keyon", "dt")


def _documents(spark, sf_dir):
    d = _decoded_rows(spark, sf_dir)
    text = F.when(F.col("event_id") % 59 == 0, F.lit("")).otherwise(F.col("text"))
    doc = decoded_json(
        F.col("decoded"), text, F.col("codec"), F.col("MODEL_CODE"), F.col("MODEL_YEAR"), F.col("msg"), "object", "object"
    )
    return d.select("event_id", "msg", doc.alias("document"))


def json_documents(spark, sf_dir):
    """Documents with family, year and type; error objects for empty messages and missing layouts."""
    d = _documents(spark, sf_dir)
    parsed = parse_decoded_json(F.col("document"))
    get = lambda path: F.get_json_object("document", path)
    return d.select(
        "event_id", "msg", get("$.error").alias("error"), get("$.vehicle_family").alias("vehicle_family"),
        get("$.model_year").alias("model_year"), get("$.ddt_type").alias("ddt_type"),
        F.size(F.coalesce(F.map_keys(parsed["decoded_values"]), F.array().cast("array<string>"))).alias("n_fields"),
        from_json_value(parsed, "Supply Voltage", "float").alias("supply_voltage"),
        from_json_value(parsed, "Latest start cause", "string").alias("latest_start_cause"),
    )


def error_documents(spark, sf_dir):
    """documents that hold the word error."""
    return _documents(spark, sf_dir).where(has_error(F.col("document"))).select("event_id", "msg")


def document_summary(spark, sf_dir):
    """A4 + A5: rows, decoded and error counts of the documents."""
    return decoding_summary(_documents(spark, sf_dir), ["document"], TYPED)


def named_columns(spark, sf_dir):
    """Text columns by description, Reserved left out."""
    d = _decoded_rows(spark, sf_dir).where("msg = 'C1F0'")
    return d.select("event_id", *columns_by_description("decoded", ["Lamp State", "Reserved", "SID-PR"], "c"))


def placed_columns(spark, sf_dir):
    """Text columns by place in a JSON array."""
    d = _decoded_rows(spark, sf_dir).where("msg = 'B310'").select("event_id", F.to_json("decoded").alias("j"))
    return d.select("event_id", *columns_by_position("j", {"Start cause": 2, "Beyond": 40}, "b", nested=False))


def covered_fields(spark, sf_dir):
    """What each field covers."""
    d = _decoded_rows(spark, sf_dir).where("msg = 'C1F0'")
    out = field_map(d, "event_id", "text", "decoded")
    return out.select("event_id", "field_index", "first_byte", "last_byte", "covered_hex", "covered_binary")


def covered_bytes(spark, sf_dir):
    """Which fields read each byte."""
    d = _decoded_rows(spark, sf_dir).where("msg = 'B310' AND is_valid")
    out = byte_map(d, "event_id", "text", "decoded")
    return out.select("event_id", "byte", "hex", "binary", F.array_join("fields", "|").alias("fields"))


def latest_rows(spark, sf_dir):
    """O1 + O3: the first twenty rows by time (a limit operator)."""
    return by_time(telemetry_from_events(spark, sf_dir), ["app_timestamp", "event_id"], 20).select("event_id", "app_timestamp")


MORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        whole_table, overwritten_table, appended_table, union_written, run_metadata, summary_table, family_year_rows,
        named_families, present_messages, pattern_cast, dt_added, sample_counts, filter_effect, distinct_rows, one_family,
        all_families, prepared_family, flagged_rows, checked_family, merged_families, json_documents, error_documents,
        document_summary, named_columns, placed_columns, covered_fields, covered_bytes, latest_rows,
    )
}
