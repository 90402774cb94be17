"""End-to-end batch jobs.

``decode_pipeline`` (B7) is one lazy plan:

    scan (columns + dt filter pushed down) -> forward fill -> join vehicles
    -> join of the family dimension (lengths + codecs of all messages)
    -> validity -> filter -> decode (native expressions) -> typed columns

The only exchanges are the fill's partitioning by (vin, day) and the vehicle join
(when the master is too large to broadcast). The family dimension has one row per
(family, year); ``write_dimension`` builds it once as a table, so a decode's plan
holds a scan of that table and building the plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemsg.catalogue import Catalogue
from telemsg.operators import compiled as compiling
from telemsg.operators.compiled import CompiledCodec, compile_codec
from telemsg.operators.decode import decode, decoded_json
from telemsg.operators.flatten import add_dt_if_missing, bulk_cast, flatten, typed_columns
from telemsg.operators.quality import by_time
from telemsg.operators.timeline import forward_fill
from telemsg.operators.union import drop_duplicate_rows, union_by_name
from telemsg.operators.validate import add_validity, filter_valid, prepare_family
from telemsg.plans.joins import checked_broadcast
from telemsg.plans.sinks import write_table
from telemsg.sources.telemetry import join_vehicle, load_telemetry, read_table, vehicle_dimension

CODEC_FIELDS = ["layout_name", "has_linear", "has_table", "broken", "fields"]


def family_dimension(catalogue: Catalogue, codec: DataFrame, spark=None) -> DataFrame:
    """One row per (family, year): {m}_reference_len and {m}_codec for every message."""
    spark = spark or codec.sparkSession
    msgs = catalogue.message_codes
    lengths = catalogue.lengths_df(spark).groupBy("family", "year").agg(
        *[F.max(F.when(F.col("msg") == m, F.col("length"))).alias(f"{m}_reference_len") for m in msgs]
    )
    codecs = codec.groupBy("family", "year").agg(
        *[
            F.first(F.when(F.col("msg") == m, F.struct(*CODEC_FIELDS)), ignorenulls=True).alias(f"{m}_codec")
            for m in msgs
        ]
    )
    return lengths.join(codecs, ["family", "year"], "full_outer")


def write_dimension(catalogue: Catalogue, codec: DataFrame, path: str) -> DataFrame:
    """Write the family dimension as one table and read it back: the conversion files are read and resolved once,
    and later plans hold neither their lineage nor a job."""
    family_dimension(catalogue, codec).coalesce(1).write.mode("overwrite").parquet(path)
    return codec.sparkSession.read.parquet(path)


def codec_of(dimension: DataFrame, message_codes: list[str]) -> DataFrame:
    """Codec rows (family, year, msg, ...) of a written dimension."""
    items = F.array(*[F.struct(F.lit(m).alias("msg"), F.col(f"{m}_codec").alias("c")) for m in message_codes])
    rows = dimension.select("family", "year", F.explode(items).alias("x")).where("x.c is not null")
    return rows.select("family", "year", "x.msg", *[F.col(f"x.c.{c}").alias(c) for c in CODEC_FIELDS])


def attach_family_dimension(df: DataFrame, dim: DataFrame, family_col: str = "MODEL_CODE",
                            year_col: str = "MODEL_YEAR") -> DataFrame:
    d = checked_broadcast(dim.withColumnRenamed("family", "_fam").withColumnRenamed("year", "_yr"))
    cond = (F.col(family_col) == F.col("_fam")) & (F.col(year_col).try_cast("int") == F.col("_yr"))
    return df.join(d, cond, "left").drop("_fam", "_yr")


def decode_messages(df: DataFrame, catalogue: Catalogue, how: str = "all", include_json: bool = False,
                    keep_decoded: bool = False, family_col: str = "MODEL_CODE", year_col: str = "MODEL_YEAR",
                    aligned: bool = True, compiled: CompiledCodec | None = None) -> DataFrame:
    """Validity, filter, decode and typed columns for rows that already carry
    the family dimension columns: {m}_reference_len and {m}_codec, or with ``compiled`` {m}_layout."""
    specs = list(catalogue.messages)
    if compiled is not None:
        if include_json:
            raise ValueError("documents need the codec's own rows; decode without a compiled codec")
        return _decode_compiled(df, specs, compiled, how, keep_decoded)
    slim = aligned and not (include_json or keep_decoded)
    df = add_validity(df, {s.msg: s.column_name for s in specs})
    if how is not None:
        df = filter_valid(df, [s.msg for s in specs], how)
    for s in specs:
        df = decode(df, s.column_name, f"{s.msg}_codec", f"{s.msg}_decoded", valid_col=f"{s.msg}_is_valid", slim=slim)
    if include_json:
        df = df.withColumns(
            {
                f"{s.msg}_decode": decoded_json(
                    F.col(f"{s.msg}_decoded"), F.col(s.column_name), F.col(f"{s.msg}_codec"),
                    F.col(family_col), F.col(year_col), s.msg,
                )
                for s in specs
            }
        )
    df = flatten(df, specs, aligned=aligned, slim=slim)
    drop = [f"{s.msg}_codec" for s in specs]
    if not keep_decoded:
        drop += [f"{s.msg}_decoded" for s in specs]
    return df.drop(*drop)


def _decode_compiled(df: DataFrame, specs: list, compiled: CompiledCodec, how: str | None, keep_decoded: bool) -> DataFrame:
    df = add_validity(df, {s.msg: s.column_name for s in specs})
    if how is not None:
        df = filter_valid(df, [s.msg for s in specs], how)
    layouts = {f"{s.msg}_layout" for s in specs}
    kept = [c for c in df.columns if c not in layouts]
    df = compiling.prepared(df, compiled, {s.msg: s.column_name for s in specs}, lambda m: F.col(f"{m}_is_valid"))
    marker = f"{specs[0].msg}_reference_len" if specs else None
    out = [compiling.apart(F.col(c)).alias(c) if c == marker else F.col(c) for c in kept]
    if keep_decoded:
        out += [compiling.decoded_array(compiled, s).alias(f"{s.msg}_decoded") for s in specs]
    out += [c for s in specs for c in compiling.typed_columns(compiled, s)]
    return df.select(*out)


def decode_pipeline(
    telemetry: DataFrame,
    vehicles: DataFrame,
    catalogue: Catalogue,
    codec: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    how: str = "all",
    tie_breaker: str | None = None,
    include_json: bool = False,
    parse_timestamp: bool = True,
    dimension: DataFrame | None = None,
    compiled: CompiledCodec | None = None,
) -> DataFrame:
    """The full decode of a telemetry table.

    ``compiled`` (``compile_codec`` of such a codec) is the fast way: the plan holds the fields' expressions, and the
    dimension is a few numbers a family. Without it the codec's rows are interpreted:
    ``dimension`` is the written family dimension (``write_dimension``) of a
    codec built with ``declared_only=True`` and aligned (``align_codec``) to the
    catalogue; with ``codec`` alone it is resolved inside the plan. ``vehicles``
    is the raw master table (VIN, MODEL_YEAR, MODEL_CODE, MODEL_NAME)."""
    msg_cols = [m.column_name for m in catalogue.messages]
    cols = list(catalogue.telemetry_columns) or [c for c in telemetry.columns if c not in msg_cols]
    if tie_breaker and tie_breaker not in cols:
        cols.append(tie_breaker)
    df = load_telemetry(telemetry, cols, msg_cols, start, end)
    order = ["app_timestamp"] + ([tie_breaker] if tie_breaker else [])
    # the fill looks at one vehicle's rows only, so it can go before the join and shuffle fewer columns
    df = forward_fill(df, list(catalogue.ffill_columns), key="vin", order=order)
    df = join_vehicle(df, vehicle_dimension(vehicles))
    if parse_timestamp and isinstance(df.schema["app_timestamp"].dataType, T.StringType):
        # parsed as wall-clock time (TIMESTAMP_NTZ): the text carries no zone
        df = df.withColumn(
            "app_timestamp", F.try_to_timestamp("app_timestamp", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        )
    if compiled is not None:
        dim = compiled.dimension(df.sparkSession)
    else:
        dim = dimension if dimension is not None else family_dimension(catalogue, codec)
    return decode_messages(attach_family_dimension(df, dim), catalogue, how=how, include_json=include_json, compiled=compiled)


def _decode_with(df: DataFrame, catalogue: Catalogue, dimension: DataFrame | CompiledCodec, how: str | None) -> DataFrame:
    """Decode by a compiled codec, or by the family dimension's codec rows."""
    compiled = dimension if isinstance(dimension, CompiledCodec) else None
    rows = compiled.dimension(df.sparkSession) if compiled is not None else dimension
    return decode_messages(attach_family_dimension(df, rows), catalogue, how=how, compiled=compiled)


def decode_family(df: DataFrame, family: str, year: int, catalogue: Catalogue, dimension: DataFrame | CompiledCodec,
                  how: str | None = None) -> DataFrame:
    """B1: decode the rows of one (family, year) (rows already joined to vehicles)."""
    one = df.filter((F.col("MODEL_CODE") == family) & (F.col("MODEL_YEAR").try_cast("int") == year))
    return _decode_with(one, catalogue, dimension, how)


def decode_all_families(df: DataFrame, catalogue: Catalogue, dimension: DataFrame | CompiledCodec, how: str | None = None) -> DataFrame:
    """B2: every (family, year) in one plan; the codec join selects each row's rules,
    so there is no loop over families and no union."""
    return _decode_with(df, catalogue, dimension, how)


def check_decode_family(df: DataFrame, family: str, year: int, catalogue: Catalogue, dimension: DataFrame | CompiledCodec,
                        order: list[str] | str = "app_timestamp") -> DataFrame:
    """Length check -> decode -> typed columns -> sort, for one (family, year) (rows already joined to vehicles)."""
    columns = {m.msg: m.column_name for m in catalogue.messages}
    lengths = catalogue.lengths_df(df.sparkSession)
    ready = prepare_family(df, family, year, lengths, list(columns), columns)
    ready = ready.filter(F.col("MODEL_YEAR").try_cast("int") == year)
    return by_time(_decode_with(ready, catalogue, dimension, None), order)


def merge_family_tables(frames: list[DataFrame], types: dict[str, str], target: str, ts_col: str = "app_timestamp",
                        distinct: bool = False) -> DataFrame:
    """Union of family tables by name -> bulk cast -> ``dt`` if missing -> overwrite ``target``; returns the table
    as written. A frame given twice is in it twice, unless ``distinct``."""
    out = union_by_name(frames)
    if distinct:
        out = drop_duplicate_rows(out)
    out = add_dt_if_missing(bulk_cast(out, types), ts_col)
    write_table(out, target, "overwrite")
    return read_table(out.sparkSession, target)


__all__ = [
    "check_decode_family", "merge_family_tables", "write_dimension", "codec_of",
    "compile_codec", "decode_pipeline", "decode_messages", "decode_family", "decode_all_families",
    "family_dimension", "attach_family_dimension", "typed_columns",
]
