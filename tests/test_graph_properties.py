"""Merge semantics: first write wins, order-insensitive, idempotent replays."""

from pyspark.sql import functions as F

from conftest import SMALL
from helpers import spark_rows
from sensorweave.operators import graph as G
from sensorweave.plans import graph_build as GB
from sensorweave.plans.proxy import telemetry
from sensorweave.session import scratch_path
from sensorweave.streaming.graph_store import GraphStore


def test_merge_batches_in_any_order(spark):
    tel = telemetry(spark, SMALL)
    even = tel.filter(F.dayofmonth("ts") % 2 == 0)
    odd = tel.filter(F.dayofmonth("ts") % 2 == 1)
    whole = spark_rows(GB.merge_sensor(tel))
    assert spark_rows(GB.merge_sensor(odd, GB.merge_sensor(even))) == whole
    assert spark_rows(GB.merge_sensor(even, GB.merge_sensor(odd))) == whole
    # replaying everything into the finished table adds nothing
    assert spark_rows(GB.merge_sensor(tel, GB.merge_sensor(tel))) == whole


def test_first_per_key_survivor_is_lowest_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, "b"), ("j", 5, "z"), (None, 0, "n")],
                               "key string, ord int, v string")
    got = {r["key"]: r["v"] for r in G.first_per_key(df, ["key"], "ord").collect()}
    assert got == {"k": "a", "j": "z"}
    assert G.rejects(df, ["key"]).count() == 1
    latest = {r["key"]: r["v"] for r in G.last_per_key(df.filter("key is not null"), ["key"], "ord").collect()}
    assert latest == {"k": "c", "j": "z"}


def test_graph_store_batch_rerun_and_replay(spark):
    tel = telemetry(spark, SMALL).withColumn("timestamp", F.col("ts").cast("timestamp"))
    tel = tel.withColumn("obs_ts", F.col("timestamp"))
    store = GraphStore(spark, scratch_path(spark, "test-graph"))
    store.seed()
    first = tel.filter(F.dayofmonth("ts") <= 15)
    store.upsert_batch(first, 0)
    before = spark_rows(store.keys_view())
    store.upsert_batch(first, 0)            # the same batch re-run after a failure
    assert spark_rows(store.keys_view()) == before
    store.upsert_batch(first, 1)            # the same events replayed later
    assert spark_rows(store.keys_view()) == before
    store.upsert_batch(tel, 2)
    store.upsert_batch(tel, 0, run_id="another")   # a new checkpoint over the filled store
    after = store.keys_view()
    instants = tel.select("obs_ts").distinct().count()
    assert after.filter(F.col("tbl") == "sensor").count() == instants


    whole = spark_rows(after)
    assert spark_rows(store.compact_to(scratch_path(spark, "test-compact")).keys_view()) == whole


def test_batch_and_stored_graph_agree(spark):
    from sensorweave.plans.reports import _graph
    tel = telemetry(spark, SMALL)
    built, stored = GB.TelemetryGraph(spark, tel), _graph(spark, SMALL)
    for name in ("log_notification", "has_record", "sensor", "has_sensor", "environment_sensor", "has_reading"):
        a, b = getattr(built, name), getattr(stored, name)
        assert spark_rows(a) == spark_rows(b.select(*a.columns))
    instants = tel.select("obs_ts").distinct().count()
    assert built.sensor.count() == instants < tel.count()
    # without the ingest's deduplication a second joint at the same instant keeps its link
    assert GB.TelemetryGraph(spark, tel, dedup=False).has_sensor.count() > built.has_sensor.count()


def test_retried_summary_batch_changes_nothing(spark):
    from sensorweave.streaming import jobs as J
    store = GraphStore(spark, scratch_path(spark, "test-summary"))
    rows = spark.createDataFrame([("error", 3, "2024-01-01 00:05:00"), ("info", 4, "2024-01-01 00:05:00")],
                                 "logType string, count long, timestamp string")
    J.upsert_summary(store, "log_summary", rows, 0)
    assert store.read("log_summary") is None   # no anchor, no write
    store.seed()
    for batch, ts in enumerate(["00:05", "00:10", "00:15", "00:15", "00:10"]):
        J.upsert_summary(store, "log_summary", rows.withColumn("timestamp", F.lit(ts)).withColumn("count", F.lit(batch).cast("long")), min(batch, 2))
    assert store.read("log_summary").count() <= 2 * 2
    logs = G.last_per_key(store.read("log_summary").drop("slot"), ["logType"], ["timestamp"])
    assert {(r.logType, r.timestamp, r.src, r.edge) for r in logs.collect()} == {
        ("error", "00:15", "Log", "HAS_LOG_SUMMARY"), ("info", "00:15", "Log", "HAS_LOG_SUMMARY")}


def test_graph_store_null_keys_are_rejected(spark):
    tel = telemetry(spark, SMALL).limit(50).withColumn("timestamp", F.lit(None).cast("timestamp"))
    tel = tel.withColumn("obs_ts", F.col("timestamp"))
    store = GraphStore(spark, scratch_path(spark, "test-rejects"))
    store.seed()
    m = store.upsert_batch(tel, 0)
    assert m["records"] == 50
    assert store.read("rejects").count() == 50
    assert store.read("sensor") is None or store.read("sensor").count() == 0


def test_log_write_needs_the_seeded_anchor(spark):
    tel = telemetry(spark, SMALL).withColumn("timestamp", F.col("ts").cast("timestamp"))
    tel = tel.withColumn("obs_ts", F.col("timestamp"))
    store = GraphStore(spark, scratch_path(spark, "test-noseed"))
    store.upsert_batch(tel, 0)
    assert store.read("log_notification") is None
    assert store.read("sensor").count() > 0


def test_unseeded_store_creates_joint_and_environment_nodes(spark):
    tel = telemetry(spark, SMALL).withColumn("timestamp", F.col("ts").cast("timestamp"))
    tel = tel.withColumn("obs_ts", F.col("timestamp"))
    store = GraphStore(spark, scratch_path(spark, "test-unseeded"))
    store.upsert_batch(tel, 0)
    store.upsert_batch(tel, 1)
    assert sorted(r["name"] for r in store.read("joint").collect()) == [f"joint_{i}" for i in range(1, 7)]
    assert [r["name"] for r in store.read("environment").collect()] == ["Environment"]
    seeded = GraphStore(spark, scratch_path(spark, "test-seeded"))
    seeded.seed()
    seeded.upsert_batch(tel, 0)
    assert seeded.read("joint") is None or seeded.read("joint").count() == 0
