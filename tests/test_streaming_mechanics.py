"""Late rows, live queries, and topic positions."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL
from sensorweave import schemas as S
from sensorweave.operators import parse as P
from sensorweave.plans import stream_queries as Q
from sensorweave.plans.proxy import telemetry
from sensorweave.session import scratch_path
from sensorweave.sinks.topic import next_offsets, publish_records
from sensorweave.streaming import jobs as J
from sensorweave.streaming.graph_store import GraphStore

STAGED = T.StructType([T.StructField("event_id", T.LongType()), *S.STAGING.fields])


def test_late_rows_agree_with_what_the_aggregate_drops(spark):
    """Grouped by window and record, the aggregate's progress counts each row that it drops."""
    root = scratch_path(spark, "test-late")
    late = J.LateRows(spark, f"{root}/late")
    dropped = 0
    for only in ([1], [0], [2]):
        Q.write_staging(spark, SMALL, f"{root}/staging", only=only)
        staged = J.staging_stream(spark, f"{root}/staging", schema=STAGED)
        late.start(staged, f"{root}/ckpt-late").awaitTermination()
        agg = (staged.withWatermark("timestamp", "5 minutes")
               .groupBy(F.window("timestamp", "5 minutes"), "event_id").count().select("window.start", "event_id", "count"))
        q = J.start_parquet_sink(agg, f"{root}/out", f"{root}/ckpt-agg")
        q.awaitTermination()
        dropped += sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    assert late.rows().count() == dropped > 100
    assert late.rows().filter("watermark is null").isEmpty()


def test_a_late_batch_run_again_writes_the_same(spark):
    root = scratch_path(spark, "test-late-again")
    late = J.LateRows(spark, root)
    rows = spark.createDataFrame([(i, f"2024-01-01 00:{i:02}:00") for i in range(0, 60, 4)], "event_id long, t string").select(
        "event_id", F.col("t").cast("timestamp").alias("timestamp"))
    late.process(rows.filter("event_id >= 40"), 0)
    for _ in range(2):
        late.process(rows, 1)
    late.process(rows.limit(0), 2)
    got = sorted((r["batch_id"], r["event_id"]) for r in late.rows().collect())
    assert got == [(1, i) for i in range(0, 50, 4)]  # the watermark is 00:51, the window of 48 ends at 00:50
    assert late.watermark_ms(0) is None and late.watermark_ms(3) == late.watermark_ms(1)


def test_two_queries_live_at_once(spark):
    root = scratch_path(spark, "test-live")
    files = Q.write_topic(spark, SMALL, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    queries = J.run_live(Q._messages(spark, f"{root}/topic", files), f"{root}/staging", store, f"{root}/ckpt")
    assert len({q.id for q in queries}) == 2 and all(q.isActive for q in queries)
    J.await_any(queries)
    assert not any(q.isActive for q in queries)


def test_the_first_to_fail_stops_the_other(spark):
    root = scratch_path(spark, "test-fail")
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()

    def broken(batch, n):
        raise ValueError("broken sink")

    bad = stream.writeStream.foreachBatch(broken).option("checkpointLocation", f"{root}/a").start()
    good = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/b").start()
    with pytest.raises(Exception, match="broken sink"):
        J.await_any([good, bad])
    assert not good.isActive


def test_offsets_go_on_and_reads_start_where_told(spark):
    root = scratch_path(spark, "test-topic")
    tel = telemetry(spark, SMALL).filter("event_id < 60")
    records = P.encode_v2(tel, key_cols=("event_id",)).select(
        F.col("event_id").cast("string").alias("key"), "value", (F.col("event_id") % 2).cast("int").alias("partition"), "event_id")
    assert next_offsets(spark, root) == {}
    publish_records(records, root, ["event_id"])
    publish_records(records, root, ["event_id"])
    n = {r["partition"]: r["count"] for r in records.groupBy("partition").count().collect()}
    assert next_offsets(spark, root) == {k: 2 * v for k, v in n.items()}
    topic = J.message_batch(spark, "parquet", root, schema=J.TOPIC_SCHEMA)
    assert topic.groupBy("partition", "offset").count().filter("count > 1").isEmpty()
    assert J.from_offsets(topic, "earliest").count() == 2 * sum(n.values())
    assert J.from_offsets(topic, {0: n[0]}).count() == n[0] + 2 * n[1]
