"""Telemetry and vehicle master sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet folder/file by path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.read.table(name_or_path)


def date_range(start: str | None = None, end: str | None = None, col: str = "dt") -> Column | None:
    """half-open range ``start <= dt < end``; an empty bound is no bound."""
    conds = []
    if start:
        conds.append(F.col(col) >= F.lit(start).cast("date"))
    if end:
        conds.append(F.col(col) < F.lit(end).cast("date"))
    if not conds:
        return None
    return conds[0] if len(conds) == 1 else conds[0] & conds[1]


def load_telemetry(df: DataFrame, columns: list[str], message_columns: list[str],
                   start: str | None = None, end: str | None = None, dt_col: str = "dt") -> DataFrame:
    """S1 + F1: declared columns and message columns; the date filter sits next
    to the scan so it is pushed into the reader (and prunes ``dt`` partitions)."""
    out = df.select(*columns, *[c for c in message_columns if c not in columns])
    cond = date_range(start, end, dt_col)
    return out.filter(cond) if cond is not None else out


def vehicle_dimension(df: DataFrame, vin: str = "VIN", year: str = "MODEL_YEAR", code: str = "MODEL_CODE",
                      name: str | None = "MODEL_NAME") -> DataFrame:
    """S3: VIN, MODEL_YEAR (as int), MODEL_CODE cut to its 2-character family, MODEL_NAME."""
    cols = [
        F.col(vin).alias("VIN"),
        F.col(year).try_cast("int").alias("MODEL_YEAR"),
        F.substring(F.col(code), 1, 2).alias("MODEL_CODE"),
    ]
    if name is not None:
        cols.append(F.col(name).alias("MODEL_NAME"))
    return df.select(*cols)


def join_vehicle(telemetry: DataFrame, vehicles: DataFrame, on: str = "vin",
                 broadcast_max_bytes: int | None = None) -> DataFrame:
    """Inner join on the vehicle id; the result keeps the telemetry's
    ``on`` column. The vehicle master grows with the fleet, so it is broadcast
    only when ``broadcast_max_bytes`` is given and its planned size is within it;
    otherwise the join is left to the planner (AQE picks broadcast at run time
    when the side is small and splits skewed partitions when it is not)."""
    from telemsg.plans.joins import checked_broadcast

    v = vehicles.withColumnRenamed("VIN", "_vin")
    if broadcast_max_bytes is not None:
        v = checked_broadcast(v, broadcast_max_bytes)
    return telemetry.join(v, telemetry[on] == v["_vin"], "inner").drop("_vin")
