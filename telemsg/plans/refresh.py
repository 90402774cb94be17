"""Incremental codec dimension (D0): only what changed in the conversion files is built again.

A manifest keeps for every conversion file its path, size and time, and the (family, year) it belongs to. A refresh
lists the files, compares them with the manifest of the last build, and rebuilds the codec rows of the (family, year)
pairs with a new, changed or missing file; a dynamic partition overwrite replaces their partitions and leaves all
others as they are. The manifest is written last, so a refresh that was interrupted is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.catalogue import Catalogue, local_rows
from telemsg.operators.codec import align_codec, build_codec
from telemsg.plans.sinks import existing_schema
from telemsg.sources.conversions import read_layouts, read_linear, read_table

_FILE_KEY = r".*/([^/]+)/(\d+)/[^/]+$"


def conversion_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, modified, family, year) of every conversion file; contents are not read."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*/*")
    return files.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        F.regexp_extract("path", _FILE_KEY, 1).alias("family"),
        F.regexp_extract("path", _FILE_KEY, 2).try_cast("int").alias("year"),
    )


def changed_keys(now: DataFrame, before: DataFrame | None) -> list[tuple[str, int]]:
    """(family, year) pairs of files that are new, changed or gone (a short configured list)."""
    if before is None:
        pairs = now
    else:
        mark = ["path", "size", "modified", "family", "year"]
        pairs = now.select(mark).exceptAll(before.select(mark)).union(before.select(mark).exceptAll(now.select(mark)))
    rows = pairs.where("year is not null").select("family", "year").distinct().collect()
    return sorted((r.family, r.year) for r in rows)


def refresh_codec(spark: SparkSession, root: str, catalogue: Catalogue, path: str, declared_only: bool = False):
    """Bring the codec table below ``path`` up to date with the files below ``root``. Returns (codec rows, the rebuilt
    (family, year) pairs)."""
    table, manifest = f"{path}/codec", f"{path}/manifest"
    now = conversion_files(spark, root)
    before = spark.read.parquet(manifest) if existing_schema(spark, manifest) is not None else None
    keys = changed_keys(now, before)
    configured = set(catalogue.family_years())
    rebuilt = [k for k in keys if k in configured]
    if rebuilt:
        ecus = local_rows(spark, [(m.msg, m.ecu) for m in catalogue.messages], "msg string, ecu string")
        layouts = read_layouts(spark, root).join(ecus, ["msg", "ecu"], "left_semi")
        wanted = local_rows(spark, rebuilt, "family string, year int")
        columns = catalogue.output_columns_df(spark).select("msg", "description") if declared_only else None
        codec = build_codec(layouts, read_linear(spark, root), read_table(spark, root), wanted, columns)
        codec = align_codec(codec, catalogue) if declared_only else codec
        # one partition a (family, year); those not in this frame stay. A pair whose files are all gone gets an empty
        # partition of its own by a row that holds no message
        gone = wanted.select(F.lit(None).cast("string").alias("msg"), "family", "year")
        rows = codec.unionByName(gone, allowMissingColumns=True)
        writer = rows.repartition("family", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("family", "year").parquet(table)
    if keys:
        files = spark.createDataFrame(now.collect(), now.schema)  # one short row a conversion file
        files.coalesce(1).write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(table).where("msg is not null"), rebuilt
