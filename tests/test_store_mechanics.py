"""Deletes on the kept graph, bucketed merge targets, and what a batch reads of the target."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.operators.buckets import BucketedTable
from sensorweave.plans import graph_build as GB
from sensorweave.plans.proxy import telemetry
from sensorweave.session import scratch_path
from sensorweave.streaming.graph_store import GraphStore


def filled(spark, n=300):
    store = GraphStore(spark, scratch_path(spark, "mechanics"))
    store.seed()
    tel = telemetry(spark, SMALL).filter(F.col("event_id") < n)
    store.upsert_batch(tel, 0)
    return store, tel


def rows(store, name, *columns):
    return sorted(map(tuple, store.read(name).select(*columns).collect()))


def test_delete_hides_nodes_and_their_edges(spark):
    store, _ = filled(spark)
    sensors, edges = rows(store, "sensor", "timestamp"), rows(store, "has_sensor", "joint_name", "sensor_timestamp")
    gone = sensors[:40]
    store.delete("sensor", spark.createDataFrame(gone, "timestamp timestamp_ntz").select(F.col("timestamp").cast(
        store.read("sensor").schema["timestamp"].dataType)), "a")
    assert rows(store, "sensor", "timestamp") == sensors[40:]
    assert rows(store, "has_sensor", "joint_name", "sensor_timestamp") == [e for e in edges if (e[1],) not in set(gone)]
    assert len(rows(store, "log_notification", "timestamp")) == len(sensors)  # another label stays


def test_delete_again_and_merge_again(spark):
    """The same delete changes nothing, another one adds to it, and a key that is merged later is there again."""
    store, tel = filled(spark)
    sensors = rows(store, "sensor", "timestamp")

    def first(k):
        return store.read("sensor").select("timestamp").orderBy("timestamp").limit(k)

    store.delete("sensor", first(10), "a")
    store.delete("sensor", first(10), "a")
    assert rows(store, "sensor", "timestamp") == sensors[10:]
    store.delete("sensor", first(5), "b")
    assert rows(store, "sensor", "timestamp") == sensors[15:]
    store.upsert_batch(tel, 1)
    assert rows(store, "sensor", "timestamp") == sensors
    store.delete("sensor", first(3), "c")
    store.upsert_batch(tel, 0)  # batch 0 run again: its rows are of now
    assert rows(store, "sensor", "timestamp") == sensors
    assert rows(GraphStore(spark, store.root), "has_sensor", "sensor_timestamp") == sensors


def test_a_delete_that_stopped_between_tables_goes_on(spark):
    store, _ = filled(spark)
    victims = store.read("sensor").select("timestamp").orderBy("timestamp").limit(7).persist()
    n = victims.count()
    real, DETACH = GraphStore.delete, __import__("sensorweave.streaming.graph_store", fromlist=["DETACH"]).DETACH
    held = DETACH.pop("sensor")
    real(store, "sensor", victims, "a")  # as if it had stopped before the edges
    DETACH["sensor"] = held
    before = len(rows(store, "has_sensor", "sensor_timestamp"))
    store.delete("sensor", store.read("sensor").select("timestamp").orderBy("timestamp").limit(7), "a")
    assert len(rows(store, "has_sensor", "sensor_timestamp")) == before - n


def test_compaction_drops_what_was_deleted(spark):
    store, _ = filled(spark)
    store.delete("sensor", store.read("sensor").select("timestamp").orderBy("timestamp").limit(9), "a")
    small = store.compact_to(scratch_path(spark, "compacted"))
    assert small.tombstones("sensor") is None and small.epoch() == 0
    assert rows(small, "sensor", "timestamp") == rows(store, "sensor", "timestamp")


def test_a_wrong_clock_opens_one_more_date(spark):
    """A batch lists the date folders that it has, not the days between its first and last record."""
    store, tel = filled(spark)
    wrong = tel.limit(2).withColumn("event_id", F.col("event_id") + 10**6).withColumn(
        "obs_ts", F.when(F.col("event_id") % 2 == 0, F.lit(dt.datetime(1970, 1, 2))).otherwise(F.lit(dt.datetime(2099, 1, 1))).cast("timestamp_ntz"))
    seen = []
    own = store._dated
    store._dated = lambda name, dates: seen.append(list(dates)) or own(name, dates)
    store.upsert_batch(wrong, 1)
    assert seen and all(len(d) <= 2 for d in seen)


def test_merge_leaves_the_bucketed_target_where_it_is(spark):
    tel = telemetry(spark, SMALL)
    table = BucketedTable(spark, ["timestamp"], 8)
    values = list(GB.SENSOR_PROPS)
    table.merge(GB.sensor_rows(tel.filter("event_id % 3 = 0")), GB.ORDER, values)
    plan = table.new_rows(GB.sensor_rows(tel), GB.ORDER, values)._jdf.queryExecution().executedPlan().toString()
    target = plan[plan.index(table.name) - 400:] if table.name in plan else plan[plan.rindex("FileScan") - 400:]
    assert "Exchange" not in target.split("FileScan")[0] and "Bucketed: true" in plan
    table.merge(GB.sensor_rows(tel), GB.ORDER, values)
    table.merge(GB.sensor_rows(tel), GB.ORDER, values)  # again: nothing new
    want = GB.merge_sensor(tel, GB.merge_sensor(tel.filter("event_id % 3 = 0")))
    assert sorted(map(str, table.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    once = table.compact()
    plan = once.new_rows(GB.sensor_rows(tel), GB.ORDER, values)._jdf.queryExecution().executedPlan().toString()
    assert once.counts().filter("n > 1").isEmpty() and once.read().count() == table.read().count()
    plan = once.counts()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    table.drop()
    once.drop()
