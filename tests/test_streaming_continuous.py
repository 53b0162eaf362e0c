"""Processing-time trigger: two queries on one stream, the run ends when either ends."""

import threading
import time

from conftest import SMALL
from sensorweave.plans.proxy import telemetry
from sensorweave.plans.stream_queries import _messages, write_topic
from sensorweave.session import scratch_path
from sensorweave.streaming import jobs as J
from sensorweave.streaming.graph_store import GraphStore


def test_processing_time_ingest(spark):
    root = scratch_path(spark, "test-continuous")
    files = write_topic(spark, SMALL, f"{root}/topic")
    total = telemetry(spark, SMALL).count()
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    errors = []

    def run():
        try:
            J.run_ingest(spark, _messages(spark, f"{root}/topic", files), f"{root}/staging", store,
                         f"{root}/ckpt", trigger={"processingTime": "1 second"})
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    t = threading.Thread(target=run)
    t.start()
    deadline = time.time() + 180
    mine = []
    while time.time() < deadline:
        mine = list(spark.streams.active)  # only this run's two queries are active
        done = [sum(p["numInputRows"] for p in q.recentProgress) for q in mine]
        if len(mine) == 2 and all(d >= total for d in done):
            break
        time.sleep(1)
    assert len(mine) == 2
    observed = [sum(p["observedMetrics"]["ingest"]["rows"] for p in q.recentProgress
                    if p.get("observedMetrics", {}).get("ingest")) for q in mine]
    assert sorted(observed) == [0, total]   # messages are parsed by one of the two queries only
    mine[0].stop()          # one query ends -> the run stops the other and returns
    t.join(120)
    assert not t.is_alive() and not errors
    assert not spark.streams.active
    assert spark.read.parquet(f"{root}/staging").count() == total
    assert spark.read.parquet(store.path("metrics")).agg({"records": "sum"}).first()[0] == total
