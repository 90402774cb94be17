"""Queries registered with the driver: each runs a library operator over the
stand-in telemetry built from the driver's tables (``events``, ``customer``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.operators import compiled as compiling
from telemsg.operators.codec import align_codec, load_codec
from telemsg.operators.decode import field_rows
from telemsg.operators.flatten import bulk_cast
from telemsg.operators.quality import counts_by, distinct_values
from telemsg.operators.timeline import first_n_per_group, forward_fill
from telemsg.operators.union import union_by_name
from telemsg.operators.validate import (
    add_reference_lengths, add_validity, any_usable, codec_coverage, filter_valid, good_input_marker, length_filter,
    length_flags, length_semi_filter, length_summary, validity_expr,
)
from telemsg.plans.batch import attach_family_dimension, codec_of, compile_codec, decode_pipeline, write_dimension
from telemsg.plans.sinks import shared_path
from telemsg.sample.standin import sample_catalogue, telemetry_from_events, vehicles_from_customer
from telemsg.sources.conversions import read_linear, read_table
from telemsg.sources.telemetry import join_vehicle, load_telemetry, vehicle_dimension

MSG_COLS = {"C1F0": "diag_c1f0", "B310": "diag_B310"}


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_vehicle(telemetry_from_events(spark, sf_dir), vehicle_dimension(vehicles_from_customer(spark, sf_dir)))


_DIMENSIONS: dict[tuple[str, bool], DataFrame] = {}


def _dimension(spark: SparkSession, declared_only: bool) -> DataFrame:
    """The sample's family dimension, written once per Spark application: what a deployment would do when its
    conversion files change. Queries read the table."""
    key = (spark.sparkContext.applicationId, declared_only)
    if key not in _DIMENSIONS:
        cat = sample_catalogue()
        codec = load_codec(spark, cat.conversions_path, cat, declared_only=declared_only)
        codec = align_codec(codec, cat) if declared_only else codec
        _DIMENSIONS[key] = write_dimension(cat, codec, shared_path(spark, "sample-dimension"))
    return _DIMENSIONS[key]


_COMPILED: dict[tuple[str, bool], compiling.CompiledCodec] = {}


def _compiled(spark: SparkSession, declared_only: bool) -> compiling.CompiledCodec:
    """The sample's codec, compiled once per Spark application from its written dimension."""
    key = (spark.sparkContext.applicationId, declared_only)
    if key not in _COMPILED:
        cat = sample_catalogue()
        _COMPILED[key] = compile_codec(codec_of(_dimension(spark, declared_only), cat.message_codes), cat)
    return _COMPILED[key]


def full_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan -> forward fill -> vehicle join -> validity -> compiled decode -> typed columns."""
    return decode_pipeline(
        telemetry_from_events(spark, sf_dir), vehicles_from_customer(spark, sf_dir), sample_catalogue(),
        tie_breaker="event_id", compiled=_compiled(spark, declared_only=True),
    )


def interpreted_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 with the codec's rows interpreted, as a stream or a codec that is not known beforehand needs it."""
    return decode_pipeline(
        telemetry_from_events(spark, sf_dir), vehicles_from_customer(spark, sf_dir), sample_catalogue(),
        tie_breaker="event_id", dimension=_dimension(spark, declared_only=True),
    )


def _decoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, msg, text, codec, is_valid, decoded) of every message of every event: one scan, one decode by the
    compiled codec. ``codec`` holds what a document shows of it; its fields never travel with the rows."""
    cat, compiled = sample_catalogue(), _compiled(spark, declared_only=False)
    shown = [
        F.when(F.col(f"{m}_codec").isNotNull(), F.struct(*[F.col(f"{m}_codec")[c].alias(c) for c in ("layout_name", "broken")])).alias(f"{m}_codec")
        for m in MSG_COLS
    ]
    df = attach_family_dimension(_joined(spark, sf_dir), compiled.dimension(spark))
    df = attach_family_dimension(df, _dimension(spark, declared_only=False).select("family", "year", *shown))
    valid = lambda m: F.coalesce(validity_expr(F.col(MSG_COLS[m]), F.col(f"{m}_reference_len")), F.lit(False))
    ready = compiling.prepared(df, compiled, MSG_COLS, valid)
    items = F.array(
        *[
            F.struct(
                F.lit(s.msg).alias("msg"), F.col(MSG_COLS[s.msg]).alias("text"), F.col(f"{s.msg}_codec").alias("codec"),
                valid(s.msg).alias("is_valid"), compiling.decoded_array(compiled, s).alias("decoded"),
            )
            for s in sorted(cat.messages, key=lambda s: list(MSG_COLS).index(s.msg))
        ]
    )
    # the outer explode, so that no filter on the array is inferred below it, which would decode each message once more
    each = ready.select(compiling.apart(F.col("event_id")).alias("event_id"), "MODEL_CODE", "MODEL_YEAR", items.alias("items"))
    names = ["msg", "text", "codec", "is_valid", "decoded"]
    one = each.select("event_id", "MODEL_CODE", "MODEL_YEAR", F.explode_outer("items").alias("x"))
    return one.select("event_id", "MODEL_CODE", "MODEL_YEAR", *[F.col(f"x.{c}").alias(c) for c in names])


def decode_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every valid message, one row per (event, message, field), by the compiled codec."""
    cat, compiled = sample_catalogue(), _compiled(spark, declared_only=False)
    df = attach_family_dimension(_joined(spark, sf_dir), compiled.dimension(spark))
    valid = lambda m: validity_expr(F.col(MSG_COLS[m]), F.col(f"{m}_reference_len"))
    ready = compiling.prepared(df, compiled, MSG_COLS, valid)
    items = [F.struct(F.lit(s.msg).alias("msg"), compiling.decoded_array(compiled, s).alias("decoded")) for s in cat.messages]
    each = ready.select(compiling.apart(F.col("event_id")).alias("event_id"), F.explode(F.array(*items)).alias("x"))
    rows = field_rows(each.select("event_id", "x.msg", "x.decoded"), ["event_id", "msg"], "decoded")
    names = ["description", "decoded_value", "raw_position", "size", "msg_type", "raw_value"]
    return rows.select("event_id", "msg", "field_index", *[F.col(f"f.{c}").alias(c) for c in names])


def vehicle_join(spark, sf_dir):
    """Telemetry inner join vehicle master on vin."""
    return _joined(spark, sf_dir).select("vin", "event_id", "MODEL_YEAR", "MODEL_CODE", "MODEL_NAME")


def family_counts(spark, sf_dir):
    """A1: rows per (family, year)."""
    return counts_by(_joined(spark, sf_dir), ["MODEL_CODE", "MODEL_YEAR"])


def distinct_families(spark, sf_dir):
    """Distinct families."""
    return distinct_values(_joined(spark, sf_dir), "MODEL_CODE")


def first_n_per_family(spark, sf_dir):
    """First 5 rows of each family by time (a sampling operator)."""
    return first_n_per_group(_joined(spark, sf_dir), 5, "MODEL_CODE", ["app_timestamp", "event_id"]).select(
        "MODEL_CODE", "event_id", "app_timestamp"
    )


def date_range(spark, sf_dir):
    """half-open dt range next to the scan."""
    t = telemetry_from_events(spark, sf_dir)
    return load_telemetry(t, ["event_id", "dt"], [], "2024-01-05", "2024-01-20")


def forward_fill_query(spark, sf_dir):
    """Last non-null value per vin up to each row (two-level bucketed scan)."""
    t = telemetry_from_events(spark, sf_dir)
    return forward_fill(t, ["batteryvoltagelevel", "tbm_keyon"], key="vin", order=["app_timestamp", "event_id"]).select(
        "vin", "event_id", "app_timestamp", "batteryvoltagelevel_reference", "tbm_keyon_reference"
    )


def reference_length(spark, sf_dir):
    """Expected length per message by (family, year), null when unknown."""
    cat = sample_catalogue()
    df = add_reference_lengths(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS))
    return df.select("event_id", "MODEL_CODE", "MODEL_YEAR", "C1F0_reference_len", "B310_reference_len")


def _validity(spark, sf_dir, how):
    cat = sample_catalogue()
    df = add_validity(add_reference_lengths(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS)), MSG_COLS)
    return filter_valid(df, list(MSG_COLS), how).select(
        "event_id", "MODEL_CODE", "MODEL_YEAR", "C1F0_actual_len", "C1F0_is_valid", "B310_actual_len", "B310_is_valid"
    )


def validity_all(spark, sf_dir):
    """rows whose messages are all valid."""
    return _validity(spark, sf_dir, "all")


def validity_any(spark, sf_dir):
    """rows with at least one valid message."""
    return _validity(spark, sf_dir, "any")


def any_usable_query(spark, sf_dir):
    """rows with at least one present, non-sentinel message."""
    t = telemetry_from_events(spark, sf_dir)
    return t.filter(any_usable(list(MSG_COLS.values()))).select("event_id")


def length_summary_query(spark, sf_dir):
    """F6 + A3: length flags and per-(family, year) validation counts."""
    cat = sample_catalogue()
    flagged = length_flags(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS), MSG_COLS)
    return length_summary(flagged, list(MSG_COLS))


def good_input(spark, sf_dir):
    """goodDiagInput_{msg} = "x" when the message has its expected length, else ""."""
    cat = sample_catalogue()
    flagged = length_flags(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS), MSG_COLS)
    return good_input_marker(flagged, list(MSG_COLS)).select("event_id", "goodDiagInput_C1F0", "goodDiagInput_B310")


def length_filter_query(spark, sf_dir):
    """Keep rows whose messages all have their expected length."""
    cat = sample_catalogue()
    return length_filter(_joined(spark, sf_dir), cat.lengths_df(spark), list(MSG_COLS), MSG_COLS).select(
        "event_id", "MODEL_CODE"
    )


def length_semi(spark, sf_dir):
    """Semi-join to the configured (family, year, length) of C1F0."""
    cat = sample_catalogue()
    return length_semi_filter(_joined(spark, sf_dir), cat.lengths_df(spark), "C1F0", "diag_c1f0").select("event_id")


def union_by_name_query(spark, sf_dir):
    """Union by name of frames with different columns."""
    j = _joined(spark, sf_dir)
    a = j.filter(F.col("MODEL_YEAR") == 2024).select("event_id", "MODEL_CODE")
    b = j.filter(F.col("MODEL_YEAR") != 2024).select("event_id", "tbm_keyon")
    return union_by_name([a, b])


def bulk_cast_query(spark, sf_dir):
    """lenient bulk cast (text labels become null)."""
    t = telemetry_from_events(spark, sf_dir).select(
        "event_id",
        F.substring("diag_c1f0", 7, 4).alias("digits_int"),
        F.col("batteryvoltagelevel").alias("volt_int"),
        F.col("app_timestamp").alias("ts"),
    )
    return bulk_cast(t, {"digits_int": "int", "volt_int": "int", "ts": "timestamp"})


def codec_coverage_query(spark, sf_dir):
    """(family, year, msg) of the data and which codec parts exist."""
    cat = sample_catalogue()
    codec = codec_of(_dimension(spark, declared_only=False), cat.message_codes)
    j = _joined(spark, sf_dir)
    fy = j.select(F.col("MODEL_CODE").alias("family"), F.col("MODEL_YEAR").alias("year"))
    keys = union_by_name([fy.withColumn("msg", F.lit(m)) for m in MSG_COLS])
    linear, table = (read(spark, cat.conversions_path).where("ecu = 'BCM'") for read in (read_linear, read_table))
    return codec_coverage(keys, codec, linear, table)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "full_decode": full_decode,
    "interpreted_decode": interpreted_decode,
    "decode_message": decode_message,
    "vehicle_join": vehicle_join,
    "family_counts": family_counts,
    "distinct_families": distinct_families,
    "first_n_per_family": first_n_per_family,
    "date_range": date_range,
    "forward_fill": forward_fill_query,
    "reference_length": reference_length,
    "validity_all": validity_all,
    "validity_any": validity_any,
    "any_usable": any_usable_query,
    "length_summary": length_summary_query,
    "good_input": good_input,
    "length_filter": length_filter_query,
    "length_semi": length_semi,
    "union_by_name": union_by_name_query,
    "bulk_cast": bulk_cast_query,
    "codec_coverage": codec_coverage_query,
}
