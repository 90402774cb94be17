"""The decode plan runs on a streaming source and gives the batch result."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not available")
def test_stream_decode_equals_batch(spark):
    from telemsg.operators.codec import align_codec, load_codec
    from telemsg.plans.batch import attach_family_dimension, decode_messages, family_dimension
    from telemsg.sample.standin import sample_catalogue, telemetry_from_events, vehicles_from_customer
    from telemsg.sources.telemetry import join_vehicle, vehicle_dimension
    from telemsg.streaming.decode_stream import decode_stream

    cat = sample_catalogue()
    codec = align_codec(load_codec(spark, cat.conversions_path, cat, declared_only=True), cat)
    tel = telemetry_from_events(spark, SF)
    veh = vehicles_from_customer(spark, SF)
    src = tempfile.mkdtemp(prefix="telemsg-stream-src-")
    tel.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(tel.schema).parquet(src)
    out = decode_stream(stream, veh, cat, codec)
    q = out.writeStream.format("memory").queryName("decoded_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("decoded_stream")
    batch = decode_messages(
        attach_family_dimension(join_vehicle(spark.read.parquet(src), vehicle_dimension(veh)), family_dimension(cat, codec)), cat
    )
    cols = ["event_id", "C1F0_supply_voltage", "C1F0_lamp_state", "B310_latest_start_cause"]
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert got.count() == batch.count() > 0
