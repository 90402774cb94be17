"""Sinks (K1-K3, K5)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemsg.operators.quality import observe_groups


def existing_schema(spark, table_or_path: str, fmt: str = "parquet"):
    """Schema of a table or of all files below a path, or None where nothing is there yet. Other failures, such as
    a denied access, are raised."""
    if "/" not in table_or_path:
        return spark.table(table_or_path).schema if spark.catalog.tableExists(table_or_path) else None
    try:
        return spark.read.format(fmt).option("mergeSchema", True).load(table_or_path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_merged(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """All columns of all files below ``path``, whichever file's schema they are in (what K2 appended)."""
    return spark.read.format(fmt).option("mergeSchema", True).load(path)


def write_table(df: DataFrame, table_or_path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """K1/K2/K3: overwrite replaces data and schema; append merges the schema
    by name (missing columns on either side become null): a catalog table gets the new columns, files below a path
    are read together by ``read_merged``."""
    spark = df.sparkSession
    is_path = "/" in table_or_path
    if mode == "append" and fmt != "delta":
        existing = existing_schema(spark, table_or_path, fmt)
        if existing is not None:
            have = {c.lower() for c in df.columns}
            df = df.select(
                "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in existing.fields if f.name.lower() not in have]
            )
            if not is_path:
                known = {f.name.lower() for f in existing.fields}
                new = [f for f in df.schema.fields if f.name.lower() not in known]
                if new:
                    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                    spark.sql(f"ALTER TABLE {table_or_path} ADD COLUMNS ({kinds})")
                order = [f.name for f in existing.fields] + [f.name for f in new]
                df = df.select(*[F.col(f"`{c}`") for c in order])
    w = df.write.mode(mode).format(fmt)
    if fmt == "delta":
        w = w.option("overwriteSchema", mode == "overwrite").option("mergeSchema", mode == "append")
    elif mode == "append":
        w = w.option("mergeSchema", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path:
        w.save(table_or_path)
    else:
        w.saveAsTable(table_or_path)


@contextmanager
def whole_variants(spark) -> Iterator[None]:
    """Writes inside keep every VARIANT as one value. Otherwise Spark looks through the first rows for paths to shred and
    lays out a column a path: with a document of a hundred paths each is split up on writing and put together again on
    reading, at several times the cost of the values themselves."""
    key = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def with_run_metadata(df: DataFrame, pipeline_version: str, config_version: str, stamp=None) -> DataFrame:
    """K5: processing_timestamp (now, or ``stamp``), pipeline_version, config_version columns."""
    return df.withColumns(
        {
            "processing_timestamp": F.current_timestamp() if stamp is None else F.lit(stamp),
            "pipeline_version": F.lit(pipeline_version),
            "config_version": F.lit(config_version),
        }
    )


def save_with_summary(df: DataFrame, target: str, pipeline_version: str, config_version: str, groups: Iterable[tuple[str, int]],
                      family: str = "MODEL_CODE", year: str = "MODEL_YEAR", mode: str = "overwrite") -> DataFrame:
    """K5 + A6: write ``df`` with its run columns to ``target`` and its counts to ``{target}_summary``: the rows of each
    (family, year) of ``groups``, and under nulls the rows of all others. The counts are metrics of the write itself,
    so there is no second pass. Returns the summary table as written."""
    spark = df.sparkSession
    groups = sorted(set(groups))
    stamp = spark.sql("SELECT current_timestamp() AS t").first().t
    observed, metrics = observe_groups(with_run_metadata(df, pipeline_version, config_version, stamp), groups, family, year)
    write_table(observed, target, mode)
    counts = metrics.get
    rows = [(f, y, counts[f"g{i}"]) for i, (f, y) in enumerate(groups)]
    rows.append((None, None, counts["total_rows"] - sum(n for *_, n in rows)))
    summary = spark.createDataFrame([(*r, counts["total_rows"], stamp, pipeline_version, config_version) for r in rows],
                                    f"{family} string, {year} int, rows long, total_rows long, processing_timestamp timestamp, "
                                    "pipeline_version string, config_version string")  # fmt: skip
    write_table(summary.coalesce(1), f"{target}_summary", mode)
    return spark.read.parquet(f"{target}_summary") if "/" in target else spark.table(f"{target}_summary")


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sort: list[str] = ()) -> DataFrame:
    """A table bucketed by ``key`` and sorted inside its buckets, its files below ``path``: joins, fills and aggregations
    on the key then need no exchange of it. One file a bucket: the rows are dealt by the key first."""
    spark = df.sparkSession
    w = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key)
    w.sortBy(key, *sort).saveAsTable(name)
    return spark.table(name)


def run_summary(df: DataFrame, keys: list[str] = ("MODEL_CODE", "MODEL_YEAR")) -> DataFrame:
    """K5 summary table: rows per (family, year) with the run time."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "processing_timestamp", F.current_timestamp()
    )


def shared_path(spark, name: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``); where a local session names none, as in
    tests on one machine, a temporary folder is set for it."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='telemsg-shared-')}"
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def lineage_cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's ``spark.checkpoint.dir`` (a shared
    folder on a cluster). The folder is never invented here: set it on the session."""
    spark = df.sparkSession
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
    return df.checkpoint(eager=True)
