"""Replay-safe staging and a Kafka-style (partition, offset) tie-break."""

from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.operators import parse as P
from sensorweave.plans.proxy import telemetry
from sensorweave.plans.stream_queries import _messages, write_topic
from sensorweave.session import scratch_path
from sensorweave.sinks.topic import publish
from sensorweave.streaming import jobs as J
from sensorweave.streaming.graph_store import GraphStore


def test_staging_dedup_within_watermark_drops_replays(spark):
    root = scratch_path(spark, "test-replay-staging")
    total = telemetry(spark, SMALL).count()
    for _ in range(2):  # the producer re-sends everything once
        files = write_topic(spark, SMALL, f"{root}/topic")
        q = J.start_staging_sink(J.parsed_stream(_messages(spark, f"{root}/topic", files)), f"{root}/staging",
                                 f"{root}/ckpt", dedup_keys=["event_id"])
        q.awaitTermination()
    out = spark.read.parquet(f"{root}/staging")
    assert out.count() == total
    assert out.select("event_id").distinct().count() == total


def test_kafka_style_offsets_as_tie_break(spark):
    root = scratch_path(spark, "test-offsets")
    tel = telemetry(spark, SMALL)
    # a topic whose records carry (partition, offset) instead of an event id
    msgs = P.encode_v2(tel, key_cols=("event_id",)).select(
        (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset"), "value")
    publish(msgs, f"{root}/topic", files=4)
    schema = "partition int, offset long, value binary"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "4").parquet(f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    J.run_ingest(spark, stream, f"{root}/staging", store, f"{root}/ckpt",
                 keep=J.KAFKA_KEEP, order=list(J.KAFKA_KEEP))
    instants = tel.select("obs_ts").distinct().count()
    assert store.read("sensor").count() == instants
    assert set(spark.read.parquet(f"{root}/staging").columns) >= {"partition", "offset", "timestamp"}
