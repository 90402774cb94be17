"""Registered queries over tables laid out for the job: bucketed, partitioned, VARIANT, incremental, with metrics; and
fields wider than a bigint."""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.catalogue import local_rows
from telemsg.operators import compiled as compiling
from telemsg.operators import documents
from telemsg.operators.codec import build_codec
from telemsg.operators.decode import field_rows
from telemsg.operators.timeline import forward_fill
from telemsg.operators.validate import codec_coverage, length_semi_filter, validity_expr
from telemsg.plans.batch import attach_family_dimension
from telemsg.plans.refresh import refresh_codec
from telemsg.plans.registered import MSG_COLS, _joined
from telemsg.plans.registered_more import _documents
from telemsg.plans.sinks import save_with_summary, shared_path, whole_variants, write_bucketed, write_table
from telemsg.sample.standin import sample_catalogue, telemetry_from_events, vehicles_from_customer
from telemsg.sample.wide import BYTES, MSG, wide_codec, wide_message
from telemsg.sources.conversions import read_layout_csv, read_layouts, read_linear, read_table, write_layout_json
from telemsg.sources.telemetry import join_vehicle, load_telemetry, vehicle_dimension
from telemsg.sources.telemetry import read_table as read_any


def wide_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of 8, 9 and 16 bytes as whole numbers, by the compiled codec."""
    spec = SimpleNamespace(msg=MSG, column_name="text", lengths=(("WI", 2025, 2 * BYTES),))
    compiled = compiling.compile_codec(wide_codec(spark), SimpleNamespace(messages=[spec]))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", wide_message(F.col("event_id"), F.col("user_id")).alias("text"), F.lit(0).alias(f"{MSG}_layout")
    )
    ready = compiling.prepared(events, compiled, {MSG: "text"})
    rows = field_rows(ready.select("event_id", compiling.decoded_array(compiled, spec).alias("d")), ["event_id"], "d")
    raw = F.coalesce(F.col("f.raw_value").cast("string"), F.col("f.raw_wide"))
    return rows.select("event_id", "f.description", "f.decoded_value", raw.alias("raw_text"))


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = shared_path(spark, "bucketed")
    name = "telemsg_" + path.rpartition("-")[2]
    t = write_bucketed(telemetry_from_events(spark, sf_dir), f"{name}_t", f"{path}/t", "vin", 8, ["app_timestamp", "event_id"])
    v = vehicle_dimension(vehicles_from_customer(spark, sf_dir)).withColumnRenamed("VIN", "vin")
    return t, write_bucketed(v, f"{name}_v", f"{path}/v", "vin", 8)


def bucketed_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + W1 over tables bucketed by the vehicle: neither the join nor the fill exchanges the telemetry."""
    t, v = _bucketed(spark, sf_dir)
    joined = join_vehicle(t, v.withColumnRenamed("vin", "VIN").hint("merge"))
    out = forward_fill(joined, ["batteryvoltagelevel", "tbm_keyon"], key="vin", order=["app_timestamp", "event_id"])
    return out.select("event_id", "vin", "MODEL_CODE", "MODEL_YEAR", "batteryvoltagelevel_reference", "tbm_keyon_reference")


def pruned_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + F1 over telemetry partitioned by dt: only the partitions of the range are read."""
    path = shared_path(spark, "by-day")
    write_table(telemetry_from_events(spark, sf_dir).repartition("dt"), path, "overwrite", ["dt"])
    cols = ["vin", "event_id", "dt"]
    return load_telemetry(read_any(spark, path), cols, ["diag_c1f0"], "2024-01-05", "2024-01-20")


def pruned_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 / J4 over telemetry partitioned by family and year: the lengths' keys prune the partitions at run time."""
    path = shared_path(spark, "by-family")
    write_table(_joined(spark, sf_dir).repartition("MODEL_CODE", "MODEL_YEAR"), f"{path}/t", "overwrite", ["MODEL_CODE", "MODEL_YEAR"])
    write_table(sample_catalogue().lengths_df(spark), f"{path}/lengths", "overwrite")
    t, lengths = read_any(spark, f"{path}/t"), read_any(spark, f"{path}/lengths").where("year = 2025")
    return length_semi_filter(t, lengths, "C1F0", "diag_c1f0").select("event_id", "MODEL_CODE", "MODEL_YEAR")


def variant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10-D12, X1, X2, X5 with the documents kept as VARIANT in a table: parsed once a row, then read by path."""
    path = shared_path(spark, "documents")
    d = _documents(spark, sf_dir).select("event_id", "msg", documents.as_variant(F.col("document")).alias("document"))
    with whole_variants(spark):
        write_table(d, path, "overwrite")
    doc = F.col("document")
    return read_any(spark, path).select(
        "event_id", "msg", documents.member(doc, "error").alias("error"),
        documents.member(doc, "vehicle_family").alias("vehicle_family"), documents.member(doc, "model_year").alias("model_year"),
        documents.member(doc, "ddt_type").alias("ddt_type"), documents.field_count(doc).alias("n_fields"),
        documents.field_value(doc, "Supply Voltage", "double").alias("supply_voltage"),
        documents.field_value(doc, "Latest start cause").alias("latest_start_cause"),
    )


def refreshed_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D0 + J8: the codec table built by a refresh, refreshed again without a change, and the data's coverage by it."""
    cat, path = sample_catalogue(), shared_path(spark, "refreshed")
    refresh_codec(spark, cat.conversions_path, cat, path)
    codec, rebuilt = refresh_codec(spark, cat.conversions_path, cat, path)
    j = _joined(spark, sf_dir)
    keys = j.select(F.col("MODEL_CODE").alias("family"), F.col("MODEL_YEAR").alias("year")).withColumn(
        "msg", F.explode(F.array(*[F.lit(m) for m in MSG_COLS]))
    )
    linear, table = (read(spark, cat.conversions_path).where("ecu = 'BCM'") for read in (read_linear, read_table))
    return codec_coverage(keys, codec, linear, table).withColumn("rebuilt", F.lit(len(rebuilt)))


def _saved(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = shared_path(spark, "saved")
    rows = _joined(spark, sf_dir).select("event_id", "MODEL_CODE", "MODEL_YEAR")
    return path, save_with_summary(rows, path, "2", "7", [("AU", 2024), ("AU", 2025), ("BU", 2025), ("XX", 2030)])


def saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the table as saved, with its run columns; its time is that of the summary (as a flag, so that runs agree)."""
    path, summary = _saved(spark, sf_dir)
    stamp = summary.agg(F.max("processing_timestamp").alias("stamp"))
    out = read_any(spark, path).join(F.broadcast(stamp), F.lit(True))
    return out.select("event_id", "MODEL_CODE", "pipeline_version", "config_version", (F.col("processing_timestamp") == F.col("stamp")).alias("same_run"))


def saved_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + A6: the summary table, whose counts are metrics of the write."""
    return _saved(spark, sf_dir)[1].select("MODEL_CODE", "MODEL_YEAR", "rows", "total_rows", "pipeline_version", "config_version")


def round_trip_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts as CSV files, converted to JSON files, read, built into a codec and decoded with."""
    cat, path = sample_catalogue(), shared_path(spark, "layouts")
    layouts = read_layouts(spark, cat.conversions_path).where("family IN ('AU', 'BU')")
    quoted = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in ("byte", "description", "size", "type", "name", "id")]
    lines = layouts.groupBy("family", "year", "ecu", "msg").agg(
        F.array_sort(F.collect_list(F.struct("ord", F.concat_ws(",", *quoted).alias("line")))).alias("lines")
    )
    header = F.array(F.lit("ByteBit,ByteBit_Description,Size,Type,Name,ID"))
    text = F.array_join(F.concat(header, F.transform("lines", lambda x: x["line"])), "\n")
    stem = F.concat_ws("_", F.lit("DDT"), "ecu", "msg", "family", F.col("year").cast("string"))
    files = lines.select(text.alias("value"), stem.alias("stem"))
    files.repartition("stem").write.partitionBy("stem").text(f"{path}/csv")
    # a folder a file here; the name comes from it
    converted = read_layout_csv(spark, f"{path}/csv/*/*").withColumn("name", F.concat(F.regexp_extract("file", r"stem=([^/]+)/", 1), F.lit(".csv")))
    write_layout_json(converted, f"{path}/json")
    cells = {"linear": read_linear(spark, cat.conversions_path), "table": read_table(spark, cat.conversions_path)}
    years = local_rows(spark, cat.family_years(), "family string, year int")
    ecus = local_rows(spark, [(m.msg, m.ecu) for m in cat.messages], "msg string, ecu string")
    codec = build_codec(read_layouts(spark, f"{path}/json").join(ecus, ["msg", "ecu"], "left_semi"), cells["linear"], cells["table"], years)
    compiled = compiling.compile_codec(codec, cat)
    df = attach_family_dimension(_joined(spark, sf_dir).where("MODEL_CODE IN ('AU', 'BU')"), compiled.dimension(spark))
    valid = lambda m: validity_expr(F.col(MSG_COLS[m]), F.col(f"{m}_reference_len"))
    ready = compiling.prepared(df, compiled, MSG_COLS, valid)
    items = [F.struct(F.lit(s.msg).alias("msg"), compiling.decoded_array(compiled, s).alias("decoded")) for s in cat.messages]
    each = ready.select("event_id", F.explode(F.array(*items)).alias("x")).select("event_id", "x.msg", "x.decoded")
    rows = field_rows(each, ["event_id", "msg"], "decoded")
    return rows.select("event_id", "msg", "field_index", "f.description", "f.decoded_value", "f.raw_value")


TABLE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        wide_fields, bucketed_fill, pruned_range, pruned_semi, variant_documents, refreshed_coverage, saved_table,
        saved_summary, round_trip_decode,
    )
}
