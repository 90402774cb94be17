"""Stand-in inputs built from the driver's test tables.

They only give rows in the shape the decode job expects (telemetry with hex
message columns, a vehicle master); all decoding work is done by the library
on these rows. Message bytes are plain functions of the event columns, so the
same text can be written in any SQL dialect (``printf``/``format_string``).
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemsg.catalogue import Catalogue, load_catalogue

SAMPLE_DIR = Path(__file__).parent
SAMPLE_CONFIG = SAMPLE_DIR / "config.json"


def sample_catalogue() -> Catalogue:
    return load_catalogue(SAMPLE_CONFIG)


def telemetry_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vin, app_timestamp text, event_id, batteryvoltagelevel, tbm_keyon, dt,
    diag_c1f0, diag_B310) — one row per event, vin = user id."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    eid, uid = F.col("event_id"), F.col("user_id")
    a = F.format_string(
        "62C1F0%04X%02X%02X%02X%04X",
        (eid * 40503) % 65536, uid % 256, (eid * 7) % 256, (eid * 13 + uid) % 256, (eid * 977) % 65536,
    )
    w = F.format_string("62B310%02X%02X%02X%02X", (eid * 3) % 32, uid % 24, (eid + uid) % 256, eid % 17)
    diag_a = (
        F.when(eid % 53 == 0, F.lit(None).cast("string"))
        .when(eid % 47 == 0, F.lit("E#1"))
        .when(eid % 43 == 0, a.substr(1, 18))
        .when(eid % 37 == 0, F.concat(a.substr(1, 10), F.lit("ZZ"), a.substr(13, 100)))
        .otherwise(a)
    )
    return e.select(
        uid.cast("string").alias("vin"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("app_timestamp"),
        eid,
        F.when(eid % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("batteryvoltagelevel"),
        F.when(F.col("event_type").isin("click", "purchase"), F.col("event_type")).alias("tbm_keyon"),
        F.to_date("ts").alias("dt"),
        diag_a.alias("diag_c1f0"),
        F.when(eid % 59 == 0, F.lit(None).cast("string")).otherwise(w).alias("diag_B310"),
    )


def vehicles_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(VIN, MODEL_YEAR, MODEL_CODE, MODEL_NAME): the raw master, code not yet cut."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(
        F.col("c_custkey").cast("string").alias("VIN"),
        (F.lit(2024) + F.col("c_nationkey") % 3).cast("int").alias("MODEL_YEAR"),
        F.col("c_mktsegment").alias("MODEL_CODE"),
        F.col("c_name").alias("MODEL_NAME"),
    )
