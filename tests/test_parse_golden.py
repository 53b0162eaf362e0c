"""Golden record and malformed-input behaviour of the ingest projection."""

import json

from pyspark.sql import functions as F

from sensorweave.operators import parse as P

GOLDEN = {
    "timestamp": "2024-09-05 11:33:56.399981",
    "sensor_name": "joint_1_sensor",
    "joint_name": "joint_1",
    "position": json.dumps({"x": 1.0, "y": 0.0, "z": 0.0}),
    "force_torque": json.dumps({"force": {"x": 10.0, "y": 0.0, "z": 0.0},
                                "torque": {"x": 0.0, "y": 0.0, "z": 0.0}}),
    "joint_angle": "0.0",
    "velocity": "0.1",
    "current": "2.5",
    "environment": json.dumps({"temperature": 25.0, "humidity": 50.0, "air_quality": "Good"}),
    "log": json.dumps({"type": "info", "timestamp": "2024-09-05T11:29:59Z", "message": "Info log message"}),
}


def _msgs(spark, payloads):
    rows = [(i, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "event_id long, value binary")


def test_golden_record(spark):
    df = P.ingest_v2(_msgs(spark, [json.dumps(GOLDEN).encode()]))
    r = df.select(*[F.col(c) for c in df.columns if c not in ("timestamp", "log_timestamp")],
                  F.col("timestamp").cast("string").alias("ts"),
                  F.col("log_timestamp").cast("string").alias("lts")).first()
    assert r["ts"] == "2024-09-05 11:33:56.399981"
    assert (r["sensor_name"], r["joint_name"]) == ("joint_1_sensor", "joint_1")
    assert (r["position_x"], r["position_y"], r["position_z"]) == (1.0, 0.0, 0.0)
    assert (r["force_x"], r["force_y"], r["force_z"]) == (10.0, 0.0, 0.0)
    assert (r["torque_x"], r["torque_y"], r["torque_z"]) == (0.0, 0.0, 0.0)
    assert (r["joint_angle"], r["velocity"], r["current"]) == (0.0, 0.1, 2.5)
    # a bare number read into a text field keeps its text
    assert (r["environment_air_quality"], r["environment_humidity"], r["environment_temperature"]) == \
        ("Good", "50.0", 25.0)
    assert r["lts"] == "2024-09-05 11:29:59"
    assert (r["log_type"], r["log_message"]) == ("info", "Info log message")


def test_bad_inputs_become_nulls(spark):
    bad_velocity = dict(GOLDEN, velocity="fast")
    no_ts = dict(GOLDEN, timestamp=None)
    swapped = {v: k for k, v in GOLDEN.items() if isinstance(v, str) and len(v) < 30}
    payloads = [b"\xff\xfe{not utf8", b"{malformed json", json.dumps(bad_velocity).encode(),
                json.dumps(no_ts).encode(), json.dumps(swapped).encode()]
    rows = {r["event_id"]: r for r in P.ingest_v2(_msgs(spark, payloads)).collect()}
    assert all(v is None for k, v in rows[0].asDict().items() if k != "event_id")
    assert all(v is None for k, v in rows[1].asDict().items() if k != "event_id")
    assert rows[2]["velocity"] is None and rows[2]["current"] == 2.5
    assert rows[3]["timestamp"] is None and rows[3]["joint_name"] == "joint_1"
    assert rows[4]["joint_name"] is None and rows[4]["timestamp"] is None


def test_v1_single_quoted_members(spark):
    msg = {"force_torque": "{'force': {'x': 1.0, 'y': 2.0, 'z': 3.0}, 'torque': {'x': 4.0, 'y': 5.0, 'z': 6.0}}",
           "timestamp": "2024-09-05 11:33:56", "position": "{'x': 0.5, 'y': 0.25, 'z': 0.125}",
           "joint_angles": "{'joint_1': 10.0, 'joint_6': 60.0}", "gripper_status": "open"}
    r = P.parse_v1(_msgs(spark, [json.dumps(msg).encode()])).first()
    assert r["force_torque"]["torque"]["z"] == 6.0
    assert r["position"]["y"] == 0.25
    assert r["joint_angles"]["joint_1"] == 10.0 and r["joint_angles"]["joint_2"] is None
    assert r["gripper_status"] == "open"
