"""The graph reports run unchanged over the graph the streaming ingest accumulated."""

from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.plans import catalog  # noqa: F401 - registers every query
from sensorweave.plans.reports import REPORTS
from sensorweave.plans.stream_queries import _messages, write_topic
from sensorweave.session import scratch_path
from sensorweave.streaming import jobs as J
from sensorweave.streaming.graph_store import GraphStore, StoredGraph


def test_reports_over_stored_graph(spark):
    root = scratch_path(spark, "test-reports-store")
    files = write_topic(spark, SMALL, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    J.run_ingest(spark, _messages(spark, f"{root}/topic", files), f"{root}/staging", store, f"{root}/ckpt")
    g = StoredGraph(store)
    instants = (spark.read.parquet(f"{SMALL}/events.parquet")
             .select("ts").distinct().count())
    out = {k: fn(spark, g) for k, fn in REPORTS.items()}
    assert out["count_sensors"].first()["count"] == instants
    assert out["count_environment"].first()["count"] == instants
    # per-batch dedup keeps one reading per instant, so one notification per instant
    assert out["count_notifications"].first()["count"] == instants
    assert sum(r["count"] for r in out["logs_by_type"].collect()) == instants
    errors = out["count_error_logs"].first()["count"]
    assert out["collect_error_times"].count() == errors
    assert sum(r["errorCount"] for r in out["errors_per_hour"].collect()) == errors
    for k, df in out.items():
        df.collect()  # every report executes over the stored tables


def test_approximate_distinct_per_minute_is_close(spark):
    from sensorweave.plans.reports import REPORTS, _graph
    g = _graph(spark, SMALL)
    exact = {r["minute"]: r["totalErrorCount"] for r in REPORTS["notifications_per_minute"](spark, g).collect()}
    approx = {r["minute"]: r["totalErrorCount"]
              for r in REPORTS["notifications_per_minute"](spark, g, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(1, 0.05 * v) for k, v in exact.items())
