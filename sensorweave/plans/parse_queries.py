"""Parsing queries: telemetry rows are encoded as messages, then parsed back.

The oracle for every key is the telemetry view itself (a JSON round trip of
a double is exact), so a mismatch points at the parse path.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.telemetry import format_iso_z, format_plain
from ..functions.fixed import LOG_MESSAGES
from ..operators import parse as P
from ..session import scratch_path
from ..sources.files import read_csv_in_order, read_csv_strings
from ..sinks.tables import write_ordered_csv, write_table
from ..sinks.topic import publish
from ..streaming.jobs import message_batch
from .proxy import message_sql, telemetry, with_telemetry
from .registry import register

R = 6


def _r(c, alias=None):
    return F.round(F.col(c), R).alias(alias or c)


def _keyed(spark, sf_dir):
    """The telemetry as a topic deals it: by the record's key, whatever the splits of the scan."""
    return telemetry(spark, sf_dir).repartition("event_id")


def _messages(spark, sf_dir):
    return P.encode_v2(_keyed(spark, sf_dir))


# --- P1 / V1 ------------------------------------------------------------------------------
@register("decode_utf8", sql=with_telemetry(
    "SELECT event_id, true AS valid, joint_name FROM telemetry"))
def decode_utf8(spark, sf_dir):
    d = P.decode(_messages(spark, sf_dir))
    return d.select("event_id", F.col("json").isNotNull().alias("valid"),
                    F.get_json_object("json", "$.joint_name").alias("joint_name"))


PARSED_DOUBLES = ["position_x", "position_y", "position_z", "force_x", "force_y", "force_z",
                  "torque_x", "torque_y", "torque_z", "environment_temperature"]


# --- P2 - P7 / X14 -------------------------------------------------------------------------
@register("parse_telemetry", headline=True, sql=with_telemetry(f"""
SELECT event_id, sensor_name, joint_name,
  {", ".join(f"round({c}, 6) AS {c}" for c in PARSED_DOUBLES)},
  environment_air_quality, environment_humidity, log_type, log_message FROM telemetry"""))
def parse_telemetry(spark, sf_dir):
    p = P.parse_v2(P.decode(_messages(spark, sf_dir)))
    return p.select(
        "event_id", "sensor_name", "joint_name",
        _r("position.x", "position_x"), _r("position.y", "position_y"), _r("position.z", "position_z"),
        _r("force_torque.force.x", "force_x"), _r("force_torque.force.y", "force_y"),
        _r("force_torque.force.z", "force_z"), _r("force_torque.torque.x", "torque_x"),
        _r("force_torque.torque.y", "torque_y"), _r("force_torque.torque.z", "torque_z"),
        _r("environment.temperature", "environment_temperature"),
        F.col("environment.air_quality").alias("environment_air_quality"),
        F.col("environment.humidity").alias("environment_humidity"),
        F.col("log.type").alias("log_type"), F.col("log.message").alias("log_message"))


# --- P9 ----------------------------------------------------------------------------------
@register("flatten_telemetry", sql=with_telemetry(f"""
SELECT event_id, sensor_name, joint_name,
  {", ".join(f"round({c}, 6) AS {c}" for c in PARSED_DOUBLES)},
  environment_air_quality, environment_humidity, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS log_timestamp,
  log_type, log_message FROM telemetry"""))
def flatten_telemetry(spark, sf_dir):
    f = P.flatten(P.parse_v2(P.decode(_messages(spark, sf_dir))))
    return f.select("event_id", "sensor_name", "joint_name", *[_r(c) for c in PARSED_DOUBLES],
                    "environment_air_quality", "environment_humidity", "log_timestamp",
                    "log_type", "log_message")


STAGING_DOUBLES = [f.name for f in S.STAGING.fields if f.dataType.typeName() == "double"]
STAGING_TEXT = [f.name for f in S.STAGING.fields if f.dataType.typeName() == "string"]


# --- P11 / X1: the full ingest projection -------------------------------------------------
@register("cast_telemetry", headline=True, sql=with_telemetry(f"""
SELECT event_id, ts AS timestamp, date_trunc('second', ts) AS log_timestamp,
  {", ".join(f"round({c}, 6) AS {c}" for c in STAGING_DOUBLES)},
  {", ".join(STAGING_TEXT)} FROM telemetry"""))
def cast_telemetry(spark, sf_dir):
    st = P.ingest_v2(_messages(spark, sf_dir))
    return st.select("event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                     F.col("log_timestamp").cast("timestamp_ntz").alias("log_timestamp"),
                     *[_r(c) for c in STAGING_DOUBLES], *STAGING_TEXT)


# --- S2 / P2 / P12 / V2: flat sensor messages ------------------------------------------------
@register("parse_flat_sensor", sql=with_telemetry("""
SELECT event_id, log_type AS detail_log_type, round(position_x, 6) AS position_x,
  round(position_y, 6) AS position_y, round(force_y, 6) AS acceleration_y,
  round(force_x, 6) AS acceleration_x, round(environment_temperature, 6) AS temperature,
  sensor_name AS sensor, round(k, 6) AS pressure, round(velocity, 6) AS velocity_x,
  round(current, 6) AS velocity_y, ts AS timestamp FROM telemetry"""))
def parse_flat_sensor(spark, sf_dir):
    """Messages published to a topic folder (K8), read back in one batch from the
    earliest offset (S2), parsed and cast (P2, P12)."""
    topic = scratch_path(spark, "flat-topic")
    publish(P.encode_flat(_keyed(spark, sf_dir)), topic)
    p = P.parse_flat(message_batch(spark, "parquet", topic))
    return p.select("event_id",
                    F.get_json_object("more_details", "$.log_type").alias("detail_log_type"),
                    *[_r(c) for c in S.FLAT_SENSOR_DOUBLES], "sensor",
                    F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


# --- P8 / P10: v1 robot messages, nested members kept as structs -------------------------------
@register("parse_robot_v1", sql=with_telemetry("""
SELECT event_id, ts AS timestamp, round(joint_angle, 6) AS joint_1, round(torque_x, 6) AS joint_2,
  round(position_x, 6) AS joint_3, round(position_y, 6) AS joint_4, round(force_y, 6) AS joint_5,
  round(velocity, 6) AS joint_6, round(position_z, 6) AS position_z, round(torque_y, 6) AS torque_y,
  CASE WHEN log_type = 'error' THEN 'open' ELSE 'closed' END AS gripper_status FROM telemetry"""))
def parse_robot_v1(spark, sf_dir):
    p = P.parse_v1(P.encode_v1(_keyed(spark, sf_dir)))
    return p.select("event_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                    *[_r(f"joint_angles.joint_{i}", f"joint_{i}") for i in range(1, 7)],
                    _r("position.z", "position_z"), _r("force_torque.torque.y", "torque_y"),
                    "gripper_status")


# --- S5 / K8 / X12: CSV rows -> JSON messages ----------------------------------------------------
@register("csv_to_json_messages", sql=with_telemetry("""
SELECT event_id, sensor_name, joint_name, round(position_x, 6) AS position_x, log_type
FROM telemetry"""))
def csv_to_json_messages(spark, sf_dir):
    """Rows written as CSV (nested members as JSON text), read back all-text with a
    header, published as JSON messages, and parsed again."""
    tel = telemetry(spark, sf_dir)
    wire = P.encode_v2(tel).select("event_id", F.col("value").cast("string").alias("j"))
    rows = wire.select(F.col("event_id").cast("string").alias("event_id"),
                       F.from_json("j", S.MESSAGE_V2).alias("m")).select("event_id", "m.*")
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    back = read_csv_strings(spark, path)
    msgs = back.select(F.col("event_id").try_cast("bigint").alias("event_id"),
                       F.to_json(F.struct(*[c for c in back.columns if c != "event_id"]))
                       .cast("binary").alias("value"))
    st = P.ingest_v2(msgs)
    return st.select("event_id", "sensor_name", "joint_name", _r("position_x"), "log_type")


# --- S4 / P13: Parquet staging scan with inferred schema, two-column projection ---------------------
@register("project_sensor_temperature", sql=with_telemetry("""
SELECT sensor_name, ts AS timestamp, round(environment_temperature, 6) AS environment_temperature
FROM telemetry"""))
def project_sensor_temperature(spark, sf_dir):
    st = P.ingest_v2(_messages(spark, sf_dir))
    path = scratch_path(spark, "staging")
    write_table(st, path)
    back = spark.read.parquet(path)
    return back.select("sensor_name", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                       _r("environment_temperature"))


# --- X13 -------------------------------------------------------------------------------------
@register("format_timestamps", sql=with_telemetry("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM telemetry"""))
def format_timestamps(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    return tel.select("event_id", format_plain("ts").alias("plain"), format_iso_z("ts").alias("iso"))


# --- X15: type -> message lookup through a literal map --------------------------------------------
@register("log_message_lookup", sql=with_telemetry(
    f"SELECT event_id, log_type, {message_sql('log_type')} AS message FROM telemetry"))
def log_message_lookup(spark, sf_dir):
    m = F.create_map(*[x for k, v in LOG_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    tel = telemetry(spark, sf_dir)
    return tel.select("event_id", "log_type", F.try_element_at(m, F.col("log_type")).alias("message"))


# --- O5: a time-ordered CSV, read back in file order -----------------------------------------------
@register("ordered_csv", sql=with_telemetry("""
SELECT event_id, sensor_name, row_number() OVER (ORDER BY ts, event_id) AS position FROM telemetry"""))
def ordered_csv(spark, sf_dir):
    """All readings written as CSV files in time order; each row's position is where the files have it."""
    path = scratch_path(spark, "ordered")
    rows = telemetry(spark, sf_dir).select("ts", "event_id", "sensor_name", "joint_angle")
    write_ordered_csv(rows, path, ["ts", "event_id"])
    return read_csv_in_order(spark, path).select(F.col("event_id").cast("long").alias("event_id"), "sensor_name", "position")
