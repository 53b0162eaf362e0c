"""Node and edge tables of the telemetry graph, built from telemetry rows.

Node tables (label -> key):
  LogNotification   (name, timestamp)         props hasMessage
  Sensor            (timestamp)               props hasAcceleration ... hasVelocity
  EnvironmentSensor (hasTimestamp)            props hasAirQuality, hasHumidity, hasTemperature
  Joint             (name)                    props hasJointType (seed)
Edge tables:
  HAS_RECORD  Log -> LogNotification          (log_name, ln_name, ln_timestamp, timestamp)
  HAS_SENSOR  Joint -> Sensor                 (joint_name, sensor_timestamp, timestamp)
  HAS_READING Environment -> EnvironmentSensor (env_name, es_timestamp, timestamp)

Every node/edge write of the ingest job is an insert-if-absent keyed as above;
telemetry's ``obs_ts`` column is the event timestamp and ``event_id`` the
tie-break, so the surviving row per key is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..operators import graph as G

TS = "obs_ts"
ORDER = "event_id"

SENSOR_PROPS = {
    "hasAcceleration": "joint_angle",  # the reference fills acceleration from the joint angle
    "hasCurrent": "current",
    "hasForceX": "force_x", "hasForceY": "force_y", "hasForceZ": "force_z",
    "hasPositionX": "position_x", "hasPositionY": "position_y", "hasPositionZ": "position_z",
    "hasTorqueX": "torque_x", "hasTorqueY": "torque_y", "hasTorqueZ": "torque_z",
    "hasVelocity": "velocity",
}
ENV_PROPS = {
    "hasAirQuality": "environment_air_quality",
    "hasHumidity": "environment_humidity",
    "hasTemperature": "environment_temperature",
}


# --- seed (M1 / M2) -----------------------------------------------------------
NODE_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("props", T.MapType(T.StringType(), T.StringType())),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("src_label", T.StringType()), T.StructField("src_name", T.StringType()),
    T.StructField("dst_label", T.StringType()), T.StructField("dst_name", T.StringType()),
])


def seed_rows(full: bool = False):
    nodes = [(lbl, name, dict(p)) for lbl, name, p in fixed.SEED_ROOTS]
    nodes += [("Joint", n, {"hasJointType": t}) for n, t in fixed.SEED_JOINT_TYPES]
    nodes += [(lbl, name, {"hasTimestamp": fixed.SEED_TIMESTAMP, "hasMessage": m})
              for lbl, name, m in fixed.SEED_LOGS]
    edges = list(fixed.SEED_EDGES)
    if full:
        nodes.append(("EnvironmentSensor", "EnvironmentSensor", {}))
        edges.append(("HAS_READING", "Environment", "Environment", "EnvironmentSensor", "EnvironmentSensor"))
        for lbl, name, prop, val, etype in fixed.SEED_ENV_SUBSENSORS:
            nodes.append((lbl, name, {prop: val}))
            edges.append((etype, "EnvironmentSensor", "EnvironmentSensor", lbl, name))
        for name, kind in fixed.SEED_FULL_JOINTS:
            nodes.append(("Joint", name, {"hasJointType": kind}))
            edges.append(("HAS_JOINT", "RobotArm", "RobotArm", "Joint", name))
        for s in fixed.SEED_SENSORS:
            name, joint = s[0], s[1]
            props = dict(zip(["hasAcceleration", "hasCurrent", "hasForce", "hasPositionX",
                              "hasPositionY", "hasPositionZ", "hasTorque", "hasVelocity"],
                             [str(x) for x in s[2:]]))
            props["hasTimestamp"] = fixed.SEED_TIMESTAMP
            nodes.append(("Sensor", name, props))
            edges.append(("HAS_SENSOR", "Joint", joint, "Sensor", name))
    return nodes, edges


def seed_nodes(spark: SparkSession, full: bool = False) -> DataFrame:
    """Seed topology nodes (fixed, 15 or 31 rows); idempotent by (label, name)."""
    nodes, _ = seed_rows(full)
    return spark.createDataFrame(nodes, NODE_SCHEMA)


def seed_edges(spark: SparkSession, full: bool = False) -> DataFrame:
    _, edges = seed_rows(full)
    return spark.createDataFrame(edges, EDGE_SCHEMA)


def seed_into(nodes: DataFrame | None, edges: DataFrame | None, spark: SparkSession, full: bool = False) -> tuple[DataFrame, DataFrame]:
    """M1 / M2: MERGE the seed into existing node and edge tables; what is there stays."""
    new_nodes, new_edges = seed_nodes(spark, full), seed_edges(spark, full)
    if nodes is not None:
        new_nodes = nodes.unionByName(new_nodes.join(nodes.select("label", "name"), ["label", "name"], "left_anti"))
    if edges is not None:
        new_edges = edges.unionByName(new_edges.join(edges, EDGE_SCHEMA.names, "left_anti"))
    return new_nodes, new_edges


# --- stream-driven node and edge tables (M3 - M8) ------------------------------
def _order_cols(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def log_notification_rows(tel: DataFrame, order=ORDER) -> DataFrame:
    return tel.select(F.col("log_type").alias("name"), F.col(TS).alias("timestamp"),
                      F.col("log_message").alias("hasMessage"), *_order_cols(order))


def merge_log_notification(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M3: LogNotification insert-if-absent on (name, timestamp), message on create.

    The statement starts with MATCH (log:Log): with the seed present the rows
    are written; the seed Log node is constant, so the check is static here.
    """
    return G.merge_insert(log_notification_rows(tel), target, ["name", "timestamp"], ORDER,
                          ["hasMessage"])


def merge_has_record(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M4: HAS_RECORD {timestamp} Log -> LogNotification, unique per endpoint pair + timestamp."""
    rows = tel.select(F.lit("Log").alias("log_name"), F.col("log_type").alias("ln_name"),
                      F.col(TS).alias("ln_timestamp"), F.col(TS).alias("timestamp"))
    keys = ["log_name", "ln_name", "ln_timestamp", "timestamp"]
    new = G.distinct_edges(rows, keys)
    if target is None:
        return new
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti"))


def sensor_rows(tel: DataFrame, key_cols=(TS,), order=ORDER) -> DataFrame:
    cols = [F.col(TS).alias("timestamp")]
    if "sensor_name" in key_cols:
        cols.insert(0, F.col("sensor_name").alias("name"))
    return tel.select(*cols, *[F.col(src).alias(p) for p, src in SENSOR_PROPS.items()],
                      *_order_cols(order))


def merge_sensor(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M5: Sensor insert-if-absent keyed on timestamp only; 12 properties on create."""
    return G.merge_insert(sensor_rows(tel), target, ["timestamp"], ORDER, list(SENSOR_PROPS))


def merge_sensor_by_name(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M5 (older variant): Sensor keyed on (name, timestamp)."""
    rows = sensor_rows(tel, key_cols=("sensor_name", TS))
    return G.merge_insert(rows, target, ["name", "timestamp"], ORDER, list(SENSOR_PROPS))


def merge_joint_has_sensor(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M6: HAS_SENSOR Joint -> Sensor unique per (joint, sensor); timestamp set on create."""
    rows = tel.select(F.col("joint_name"), F.col(TS).alias("sensor_timestamp"),
                      F.col(TS).alias("timestamp"))
    # the edge timestamp equals the sensor key, so the created edge set is the
    # distinct (joint, sensor) pairs
    new = G.distinct_edges(rows, ["joint_name", "sensor_timestamp", "timestamp"])
    if target is None:
        return new
    keys = ["joint_name", "sensor_timestamp"]
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti"))


def environment_rows(tel: DataFrame, order=ORDER) -> DataFrame:
    return tel.select(F.col(TS).alias("hasTimestamp"),
                      *[F.col(src).alias(p) for p, src in ENV_PROPS.items()], *_order_cols(order))


def merge_environment_reading(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M7: EnvironmentSensor insert-if-absent on hasTimestamp, 3 properties on create."""
    return G.merge_insert(environment_rows(tel), target, ["hasTimestamp"], ORDER, list(ENV_PROPS))


def merge_has_reading(tel: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M8: HAS_READING {timestamp} Environment -> EnvironmentSensor."""
    rows = tel.select(F.lit("Environment").alias("env_name"), F.col(TS).alias("es_timestamp"),
                      F.col(TS).alias("timestamp"))
    keys = ["env_name", "es_timestamp", "timestamp"]
    new = G.distinct_edges(rows, keys)
    if target is None:
        return new
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti"))


def dedup_timestamp(tel: DataFrame) -> DataFrame:
    """One row per event timestamp, deterministic survivor (lowest event_id)."""
    return G.first_per_key(tel, [TS], ORDER)


class TelemetryGraph:
    """The graph tables a telemetry frame converges to (single merge, empty target).

    As in the ingest job, the first record of each instant is merged; with
    ``dedup=False`` every record is.
    """

    def __init__(self, spark: SparkSession, tel: DataFrame, dedup: bool = True):
        self.spark = spark
        self.tel = dedup_timestamp(tel) if dedup else tel

    @property
    def seed_nodes(self) -> DataFrame:
        return seed_nodes(self.spark)

    @property
    def seed_edges(self) -> DataFrame:
        return seed_edges(self.spark)

    @property
    def log_notification(self) -> DataFrame:
        return merge_log_notification(self.tel)

    @property
    def has_record(self) -> DataFrame:
        return merge_has_record(self.tel)

    @property
    def sensor(self) -> DataFrame:
        return merge_sensor(self.tel)

    @property
    def has_sensor(self) -> DataFrame:
        return merge_joint_has_sensor(self.tel)

    @property
    def environment_sensor(self) -> DataFrame:
        return merge_environment_reading(self.tel)

    @property
    def has_reading(self) -> DataFrame:
        return merge_has_reading(self.tel)
