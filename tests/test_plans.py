"""Physical-plan properties that matter at scale (checked on the sf0.001 plans)."""

import contextlib
import io

import pytest

from conftest import SMALL
from sensorweave.plans import catalog

BATCH_HEADLINE = [k for k in catalog.HEADLINE if not k.startswith("stream_")]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", BATCH_HEADLINE)
def test_no_cartesian_or_nested_loop_join(spark, key):
    txt = plan_text(catalog.QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in txt
    assert "BroadcastNestedLoopJoin" not in txt


def test_first_wins_merge_aggregates_map_side_and_pushes_filters(spark):
    from sensorweave.plans import graph_build, graph_queries
    first, _ = graph_queries._two_batches(spark, SMALL)
    txt = plan_text(graph_build.merge_sensor(first))
    assert "partial_min_by" in txt                      # hot keys reduced before the shuffle
    assert "LessThan(ts," in txt                        # batch filter reaches the Parquet scan
    assert "LeftAnti" in plan_text(catalog.QUERIES["merge_sensor"](spark, SMALL))


def test_ingest_parses_each_message_once(spark):
    df = catalog.QUERIES["cast_telemetry"](spark, SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    txt = buf.getvalue()
    # the outer message schema is parsed by exactly one from_json (not once per field)
    assert txt.count("from_json(StructField(timestamp,StringType,true), StructField(sensor_name") == 1
    assert "PythonUDF" not in txt and "BatchEvalPython" not in txt


def test_window_aggregate_is_partial(spark):
    txt = plan_text(catalog.QUERIES["win_log_counts"](spark, SMALL))
    assert "partial_count" in txt


def test_sensor_merge_hashes(spark):
    txt = plan_text(catalog.QUERIES["merge_sensor"](spark, SMALL))
    assert "HashAggregate" in txt and "SortAggregate" not in txt


def test_topology_is_a_broadcast_join_over_stored_tables(spark):
    txt = plan_text(catalog.QUERIES["anomaly_env_error"](spark, SMALL))
    assert "BroadcastHashJoin" in txt and txt.count("events.parquet") == 0
