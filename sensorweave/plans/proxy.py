"""Telemetry proxy over the ``events`` table.

The reference ingests robot-arm telemetry; the given tables hold a generic
event stream.  ``telemetry()`` maps every event to one flattened telemetry
record with the staging columns, so that every operator runs over data whose
size grows with the input.  ``TELEMETRY_SQL`` is the same mapping written for
DuckDB (used by the oracle queries); both must stay in step.

Mapping (one row per event and a second one for every tenth event):
  event_id     2 * event_id, and 2 * event_id + 1 for the second record (the tie-break order)
  second       every tenth event also yields an info record of the next joint, ten degrees
               on, at the same instant, so that timestamp keys collide
  obs_ts       ts (the graph's event timestamp)
  joint_name   'joint_' || (user_id % 6 + 1); sensor_name = joint_name || '_sensor'
  log_type     error -> error, signup -> warn, else info (+ fixed message text)
  joint_angle  value; position from cos/sin of the angle, force = position * 10,
               torque = angle * 0.1; error rows spike force_x to 40 and torque_y to 15
  velocity     sqrt(x^2 + y^2) * 0.1; current = |position * 10| * 0.1 (unclamped)
  environment  temperature 20 + k/10, humidity text of k, air quality Unhealthy on
               error, else by event_id % 10 (<7 Good, <9 Moderate, else Unhealthy)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import LOG_MESSAGES
from ..functions.telemetry import log_message_for
from ..sources.tables import read_table

TELEMETRY_COLUMNS = [
    "event_id", "ts", "obs_ts", "sensor_name", "joint_name", "joint_angle", "velocity", "current",
    "position_x", "position_y", "position_z", "force_x", "force_y", "force_z",
    "torque_x", "torque_y", "torque_z", "environment_air_quality", "environment_humidity",
    "environment_temperature", "log_type", "log_message", "k",
]


def _sq(c):
    return c * c


def narrow_records(ev: DataFrame) -> DataFrame:
    """One row per record, as narrow as its event: what is cheaper to move than the telemetry that ``mapped`` makes of it."""
    # the second record is a narrow flat-map in the scan stage
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return ev.select("event_id", "ts", "props", "user_id", "event_type", "value", F.explode(copies).alias("_copy")).select(
        (F.col("event_id") * 2 + F.col("_copy")).alias("event_id"), F.col("event_id").alias("_id"), "ts", "props",
        (F.col("user_id") + F.col("_copy")).alias("user_id"), (F.col("value") + 10 * F.col("_copy")).alias("value"),
        F.when(F.col("_copy") == 1, F.lit("view")).otherwise(F.col("event_type")).alias("event_type"))


def mapped(ev: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Telemetry (and the columns in ``keep``) of ``narrow_records``: one projection, no shuffle."""
    is_err = F.col("event_type") == "error"
    log_type = (F.when(is_err, F.lit("error"))
                .when(F.col("event_type") == "signup", F.lit("warn"))
                .otherwise(F.lit("info")))
    r = F.radians(F.col("value"))
    px, py, pz = F.cos(r), F.sin(r), F.sin(r) / F.lit(2.0)
    k = F.get_json_object("props", "$.k").try_cast("double")
    joint = F.concat(F.lit("joint_"), (F.col("user_id") % 6 + 1).cast("string"))
    mod10 = F.col("_id") % 10
    air = (F.when(is_err, F.lit("Unhealthy")).when(mod10 < 7, F.lit("Good"))
           .when(mod10 < 9, F.lit("Moderate")).otherwise(F.lit("Unhealthy")))
    base = ev.select(
        *keep, "event_id", "ts", "value", "props", "user_id",
        log_type.alias("log_type"), is_err.alias("_err"),
        px.alias("position_x"), py.alias("position_y"), pz.alias("position_z"),
        k.alias("k"), joint.alias("joint_name"), air.alias("environment_air_quality"),
    )
    ten = F.lit(10.0)
    return base.select(
        *keep, "event_id", "ts",
        F.col("ts").alias("obs_ts"),
        F.concat(F.col("joint_name"), F.lit("_sensor")).alias("sensor_name"),
        "joint_name",
        F.col("value").alias("joint_angle"),
        (F.sqrt(F.col("position_x") * F.col("position_x") + F.col("position_y") * F.col("position_y"))
         * F.lit(0.1)).alias("velocity"),
        (F.sqrt(_sq(F.col("position_x") * ten) + _sq(F.col("position_y") * ten)
                + _sq(F.col("position_z") * ten)) * F.lit(0.1)).alias("current"),
        "position_x", "position_y", "position_z",
        F.when(F.col("_err"), F.lit(40.0)).otherwise(F.col("position_x") * ten).alias("force_x"),
        (F.col("position_y") * ten).alias("force_y"),
        (F.col("position_z") * ten).alias("force_z"),
        (F.col("value") * F.lit(0.1)).alias("torque_x"),
        F.when(F.col("_err"), F.lit(15.0)).otherwise(F.col("value") * F.lit(0.1)).alias("torque_y"),
        (F.col("value") * F.lit(0.1)).alias("torque_z"),
        "environment_air_quality",
        F.col("k").cast("string").alias("environment_humidity"),
        (F.lit(20.0) + F.col("k") / F.lit(10.0)).alias("environment_temperature"),
        "log_type",
        log_message_for("log_type").alias("log_message"),
        "k",
    )


def telemetry_from_events(ev: DataFrame) -> DataFrame:
    """Pure column mapping: no shuffle; fuses into the scan stage."""
    return mapped(narrow_records(ev))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the telemetry view, not yet mapped."""
    return narrow_records(read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"]))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry view."""
    return mapped(records(spark, sf_dir))


def message_sql(c: str) -> str:
    """The message of a log type, in DuckDB SQL."""
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LOG_MESSAGES.items()) + " END"


# Same mapping in DuckDB SQL; numeric literals written as doubles (e0).
TELEMETRY_SQL = """
telemetry AS (
  SELECT event_id, ts, obs_ts, sensor_name, joint_name, joint_angle,
    sqrt(position_x * position_x + position_y * position_y) * 0.1e0 AS velocity,
    sqrt((position_x * 10e0) * (position_x * 10e0) + (position_y * 10e0) * (position_y * 10e0)
         + (position_z * 10e0) * (position_z * 10e0)) * 0.1e0 AS current,
    position_x, position_y, position_z,
    CASE WHEN log_type = 'error' THEN 40e0 ELSE position_x * 10e0 END AS force_x,
    position_y * 10e0 AS force_y, position_z * 10e0 AS force_z,
    joint_angle * 0.1e0 AS torque_x,
    CASE WHEN log_type = 'error' THEN 15e0 ELSE joint_angle * 0.1e0 END AS torque_y,
    joint_angle * 0.1e0 AS torque_z,
    environment_air_quality, CAST(k AS VARCHAR) AS environment_humidity,
    20e0 + k / 10e0 AS environment_temperature, log_type,
    @MESSAGE@ AS log_message,
    k
  FROM (
    SELECT event_id, ts, ts AS obs_ts,
      'joint_' || CAST(user_id % 6 + 1 AS VARCHAR) || '_sensor' AS sensor_name,
      'joint_' || CAST(user_id % 6 + 1 AS VARCHAR) AS joint_name,
      value AS joint_angle,
      cos(radians(value)) AS position_x, sin(radians(value)) AS position_y,
      sin(radians(value)) / 2e0 AS position_z,
      CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warn'
           ELSE 'info' END AS log_type,
      CASE WHEN event_type = 'error' THEN 'Unhealthy' WHEN event_id // 2 % 10 < 7 THEN 'Good'
           WHEN event_id // 2 % 10 < 9 THEN 'Moderate' ELSE 'Unhealthy' END AS environment_air_quality,
      TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
    FROM (SELECT 2 * event_id + copy AS event_id, ts, props, user_id + copy AS user_id, value + 10 * copy AS value,
                 CASE WHEN copy = 1 THEN 'view' ELSE event_type END AS event_type
          FROM events, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR event_id % 10 = 0) e
  ) b
)""".replace("@MESSAGE@", message_sql("log_type"))


def with_telemetry(sql_body: str, *extra_ctes: str) -> str:
    """Prefix a DuckDB query with the telemetry CTE (and further CTEs)."""
    ctes = ",\n".join([TELEMETRY_SQL.strip(), *[c.strip() for c in extra_ctes]])
    return f"WITH {ctes}\n{sql_body.strip()}"
