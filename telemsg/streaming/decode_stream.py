"""The decode plan on a streaming DataFrame.

Validity, the family-dimension join and the decode are stateless per row, so the
batch operators apply to ``spark.readStream`` input unchanged (a stream-static
broadcast join). The forward fill is not stateless (an unbounded window per
vehicle), so it is not part of the streaming plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from telemsg.catalogue import Catalogue
from telemsg.plans.batch import attach_family_dimension, decode_messages, family_dimension
from telemsg.plans.sinks import lineage_cut
from telemsg.sources.telemetry import join_vehicle, vehicle_dimension


def decode_stream(stream: DataFrame, vehicles: DataFrame, catalogue: Catalogue, codec: DataFrame,
                  how: str = "all") -> DataFrame:
    """Streaming telemetry -> typed decoded rows (no forward fill).
    The static family dimension is written once to the session's checkpoint
    folder (``spark.checkpoint.dir``), so the streaming plan reads a fixed table."""
    df = join_vehicle(stream, vehicle_dimension(vehicles))
    df = attach_family_dimension(df, lineage_cut(family_dimension(catalogue, codec)))
    return decode_messages(df, catalogue, how=how)


def start_parquet_sink(decoded: DataFrame, path: str, checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Append decoded rows to parquet files; ``checkpoint`` must be a shared folder
    so the query resumes after a restart or a lost executor."""
    w = decoded.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
