"""Graph build queries: seed, merges, summaries, bulk create, back-fill, delete.

Merge queries run the way the ingest job does: a first batch (events before the
middle of their time span) merged into an empty target and stored, then the *whole*
table replayed on top of the stored target - the replay only adds keys the first
batch lacked, and the final table equals a single first-wins merge of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import graph as G
from ..operators import windows as W
from ..operators.buckets import BucketedTable
from ..sinks.tables import append_nodes, write_table
from ..session import scratch_path
from ..streaming.graph_store import GraphStore, StoredGraph
from ..sources.tables import read_table
from . import graph_build as GB
from .proxy import telemetry, with_telemetry
from .registry import register
from .reports import ES_SQL, HRD_SQL, HR_RAW, HS_RAW, HS_SQL, LN_RAW, LN_SQL, SENSOR_SQL, WS_SQL, _graph, graph_sql


def _two_batches(spark, sf_dir):
    """The events before the middle of the time span, and all events."""
    tel = telemetry(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = read_table(spark, sf_dir, "events", ["ts"]).agg(F.min(us), F.max(us)).first()
    middle = F.timestamp_micros(F.lit(((lo or 0) + (hi or 0)) // 2)).cast("timestamp_ntz")
    return tel.filter(F.col("ts") < middle), tel


def _merged(spark, sf_dir, merge, name: str) -> DataFrame:
    """The first batch merged into an empty table and stored, then all events merged into what is stored."""
    first, allrows = _two_batches(spark, sf_dir)
    path = scratch_path(spark, name)
    write_table(merge(first), path)
    return merge(allrows, spark.read.parquet(path))


def _props_text(m):
    """Map column -> 'k=v,...' sorted by key (engine-neutral rendering)."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), e["value"]))), ",")


# Oracles of the seed, written by hand from the seed statements (fixed values: label, name, properties).
_SEED_NODES_SQL = """
  ('Thing', 'Thing', ''), ('RobotArm', 'RobotArm', 'hasRobotName=RoboArm1'), ('Environment', 'Environment', ''),
  ('Location', 'Location', 'inBuilding=BuildingA,inWorkstation=Workstation5'), ('PowerSupply', 'PowerSupply', 'hasVoltage=220.0'),
  ('Log', 'Log', ''), ('Joint', 'joint_1', 'hasJointType=Base Joint'), ('Joint', 'joint_2', 'hasJointType=Shoulder Joint'),
  ('Joint', 'joint_3', 'hasJointType=Elbow Joint'), ('Joint', 'joint_4', 'hasJointType=Wrist 1 Joint'),
  ('Joint', 'joint_5', 'hasJointType=Wrist 2 Joint'), ('Joint', 'joint_6', 'hasJointType=Wrist 3 Joint'),
  ('WarnLog', 'WarnLog', 'hasMessage=Warning log message,hasTimestamp=2024-07-01 12:00:00'),
  ('InfoLog', 'InfoLog', 'hasMessage=Info log message,hasTimestamp=2024-07-01 12:00:00'),
  ('ErrorLog', 'ErrorLog', 'hasMessage=Error log message,hasTimestamp=2024-07-01 12:00:00')"""
_FULL_NODES_SQL = """,
  ('EnvironmentSensor', 'EnvironmentSensor', ''), ('AirQualitySensor', 'AirQualitySensor', 'hasAirQuality=Good'),
  ('HumiditySensor', 'HumiditySensor', 'hasHumidity=45.0'), ('TemperatureSensor', 'TemperatureSensor', 'hasTemperature=22.0'),
  ('Joint', 'Joint1', 'hasJointType=Base Joint'), ('Joint', 'Joint2', 'hasJointType=Shoulder Joint'),
  ('Joint', 'Joint3', 'hasJointType=Elbow Joint'), ('Joint', 'Joint4', 'hasJointType=Wrist 1 Joint'),
  ('Joint', 'Joint5', 'hasJointType=Wrist 2 Joint'), ('Joint', 'Joint6', 'hasJointType=Wrist 3 Joint'),
  ('Sensor', 'Sensor1', 'hasAcceleration=1.5,hasCurrent=2.0,hasForce=3.0,hasPositionX=0.5,hasPositionY=1.0,hasPositionZ=1.5,hasTimestamp=2024-07-01 12:00:00,hasTorque=4.0,hasVelocity=2.5'),
  ('Sensor', 'Sensor2', 'hasAcceleration=1.2,hasCurrent=1.8,hasForce=2.5,hasPositionX=0.4,hasPositionY=0.9,hasPositionZ=1.4,hasTimestamp=2024-07-01 12:00:00,hasTorque=3.5,hasVelocity=2.0'),
  ('Sensor', 'Sensor3', 'hasAcceleration=1.3,hasCurrent=1.9,hasForce=2.8,hasPositionX=0.45,hasPositionY=0.95,hasPositionZ=1.45,hasTimestamp=2024-07-01 12:00:00,hasTorque=3.8,hasVelocity=2.3'),
  ('Sensor', 'Sensor4', 'hasAcceleration=1.4,hasCurrent=2.1,hasForce=3.1,hasPositionX=0.48,hasPositionY=0.98,hasPositionZ=1.48,hasTimestamp=2024-07-01 12:00:00,hasTorque=4.1,hasVelocity=2.4'),
  ('Sensor', 'Sensor5', 'hasAcceleration=1.6,hasCurrent=2.3,hasForce=3.4,hasPositionX=0.52,hasPositionY=1.02,hasPositionZ=1.52,hasTimestamp=2024-07-01 12:00:00,hasTorque=4.4,hasVelocity=2.6'),
  ('Sensor', 'Sensor6', 'hasAcceleration=1.7,hasCurrent=2.5,hasForce=3.6,hasPositionX=0.54,hasPositionY=1.04,hasPositionZ=1.54,hasTimestamp=2024-07-01 12:00:00,hasTorque=4.6,hasVelocity=2.7')"""
# the telemetry's joints carry the seeded names, and one robot's unknown joint (user 7 of 8) does not
_EXTRA_JOINT = "'joint_' || CAST(user_id % 6 + 1 AS VARCHAR) || '_' || CAST(user_id % 8 AS VARCHAR)"


def _seed_sql(full: bool) -> str:
    return with_telemetry(f"""
SELECT label, name, props FROM (VALUES {_SEED_NODES_SQL}{_FULL_NODES_SQL if full else ''}) v(label, name, props)
UNION ALL
SELECT DISTINCT 'Joint', {_EXTRA_JOINT}, '' FROM events WHERE user_id % 8 = 7 AND user_id IS NOT NULL""")


def seed_graph(spark, sf_dir, full: bool) -> DataFrame:
    """Seed nodes, then MERGE (j:Joint {name}) for every joint the events name.

    Seeding merges: seeding twice adds nothing, and joints already seeded match by name.
    Users of the seventh kind work a joint that no seed knows.
    """
    once = GB.seed_into(None, None, spark, full)
    seed, _ = GB.seed_into(*once, spark, full)
    seed = seed.select("label", "name", _props_text(F.col("props")).alias("props"))
    plain = F.concat(F.lit("joint_"), (F.col("user_id") % 6 + 1).cast("string"))
    own = F.when(F.col("user_id") % 8 == 7, F.concat(plain, F.lit("_"), (F.col("user_id") % 8).cast("string"))).otherwise(plain)
    seen = (read_table(spark, sf_dir, "events", ["user_id"]).select(own.alias("name"))
            .filter(F.col("name").isNotNull()).distinct())
    new = (seen.join(seed.filter(F.col("label") == "Joint").select("name"), "name", "left_anti")
           .select(F.lit("Joint").alias("label"), "name", F.lit("").alias("props")))
    return seed.unionByName(new)


@register("graph_seed", sql=_seed_sql(False))
def graph_seed(spark, sf_dir):
    return seed_graph(spark, sf_dir, False)


@register("graph_seed_full", sql=_seed_sql(True))
def graph_seed_full(spark, sf_dir):
    return seed_graph(spark, sf_dir, True)


@register("graph_seed_edges", sql=with_telemetry("""
SELECT * FROM (VALUES
  ('HAS_A', 'Thing', 'RobotArm'), ('HAS_JOINT', 'RobotArm', 'joint_1'), ('HAS_JOINT', 'RobotArm', 'joint_2'),
  ('HAS_JOINT', 'RobotArm', 'joint_3'), ('HAS_JOINT', 'RobotArm', 'joint_4'), ('HAS_JOINT', 'RobotArm', 'joint_5'),
  ('HAS_JOINT', 'RobotArm', 'joint_6'), ('HAS_LOGS', 'RobotArm', 'Log'), ('HAS_RECORD', 'Log', 'WarnLog'),
  ('HAS_RECORD', 'Log', 'InfoLog'), ('HAS_RECORD', 'Log', 'ErrorLog'), ('HAS_A', 'Thing', 'Environment'),
  ('HAS_LOCATION', 'Environment', 'Location'), ('POWERED_BY', 'Location', 'PowerSupply'),
  ('HAS_JOINT', 'RobotArm', 'Joint1'), ('HAS_JOINT', 'RobotArm', 'Joint2'), ('HAS_JOINT', 'RobotArm', 'Joint3'),
  ('HAS_JOINT', 'RobotArm', 'Joint4'), ('HAS_JOINT', 'RobotArm', 'Joint5'), ('HAS_JOINT', 'RobotArm', 'Joint6'),
  ('HAS_SENSOR', 'Joint1', 'Sensor1'), ('HAS_SENSOR', 'Joint2', 'Sensor2'), ('HAS_SENSOR', 'Joint3', 'Sensor3'),
  ('HAS_SENSOR', 'Joint4', 'Sensor4'), ('HAS_SENSOR', 'Joint5', 'Sensor5'), ('HAS_SENSOR', 'Joint6', 'Sensor6'),
  ('HAS_READING', 'Environment', 'EnvironmentSensor'), ('HAS_AIRQUALITY', 'EnvironmentSensor', 'AirQualitySensor'),
  ('HAS_HUMIDITY', 'EnvironmentSensor', 'HumiditySensor'), ('HAS_TEMPERATURE', 'EnvironmentSensor', 'TemperatureSensor')
) v(type, src, dst)
UNION ALL SELECT DISTINCT 'HAS_SENSOR', joint_name, sensor_name FROM telemetry WHERE joint_name IS NOT NULL"""))
def graph_seed_edges(spark, sf_dir):
    """The full seed's relationships, merged twice, and each joint's link to its sensors in the telemetry."""
    _, edges = GB.seed_into(*GB.seed_into(None, None, spark, True), spark, True)
    seen = telemetry(spark, sf_dir).filter(F.col("joint_name").isNotNull()).select(
        F.lit("HAS_SENSOR").alias("type"), F.col("joint_name").alias("src"), F.col("sensor_name").alias("dst")).distinct()
    return edges.select("type", F.col("src_name").alias("src"), F.col("dst_name").alias("dst")).unionByName(seen)


# --- M14 ----------------------------------------------------------------------------
@register("dedup_timestamp", sql=with_telemetry("""
SELECT obs_ts, event_id, joint_name, log_type FROM (
  SELECT *, row_number() OVER (PARTITION BY obs_ts ORDER BY event_id) AS rn
  FROM telemetry WHERE obs_ts IS NOT NULL) x WHERE rn = 1"""))
def dedup_timestamp(spark, sf_dir):
    tel = telemetry(spark, sf_dir).select("obs_ts", "event_id", "joint_name", "log_type")
    return GB.dedup_timestamp(tel)


# --- M3 - M8: insert-if-absent merges (first batch, then full replay) ----------------------
@register("merge_log_notification", headline=True,
          sql=with_telemetry("SELECT name, timestamp, hasMessage FROM ln", LN_RAW))
def merge_log_notification(spark, sf_dir):
    return _merged(spark, sf_dir, GB.merge_log_notification, "merge_log_notification")


@register("merge_has_record", sql=with_telemetry("SELECT * FROM hr", HR_RAW))
def merge_has_record(spark, sf_dir):
    return _merged(spark, sf_dir, GB.merge_has_record, "merge_has_record")


def _round_props(df: DataFrame) -> DataFrame:
    return df.select([F.round(c, 6).alias(c) if c.startswith("has") else F.col(c) for c in df.columns])


SENSOR_ROUNDED = ", ".join(
    ["timestamp"] + [f"round({p}, 6) AS {p}" for p in GB.SENSOR_PROPS])


@register("merge_sensor", headline=True,
          sql=graph_sql(f"SELECT {SENSOR_ROUNDED} FROM sensor", SENSOR_SQL))
def merge_sensor(spark, sf_dir):
    return _round_props(_merged(spark, sf_dir, GB.merge_sensor, "merge_sensor"))


@register("merge_sensor_bucketed", sql=graph_sql(f"SELECT {SENSOR_ROUNDED} FROM sensor", SENSOR_SQL))
def merge_sensor_bucketed(spark, sf_dir):
    """The merge into a stored table that is bucketed and sorted by the key: the first batch creates it, the
    whole telemetry is merged into it, and only the batch is exchanged."""
    table = BucketedTable(spark, ["timestamp"])
    for batch in _two_batches(spark, sf_dir):
        table.merge(GB.sensor_rows(batch), GB.ORDER, list(GB.SENSOR_PROPS))
    out = _round_props(table.read())
    out.schema  # resolved: the files stay when the catalogue forgets the table
    table.drop()
    return out


@register("merge_sensor_by_name", sql=with_telemetry(f"""
SELECT sensor_name AS name, obs_ts AS timestamp,
  {", ".join(f"round({src}, 6) AS {p}" for p, src in GB.SENSOR_PROPS.items())}
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_name, obs_ts ORDER BY event_id) AS rn
      FROM telemetry WHERE sensor_name IS NOT NULL AND obs_ts IS NOT NULL) x WHERE rn = 1"""))
def merge_sensor_by_name(spark, sf_dir):
    return _round_props(_merged(spark, sf_dir, GB.merge_sensor_by_name, "merge_sensor_by_name"))


@register("merge_joint_has_sensor", sql=with_telemetry("SELECT * FROM hs", HS_RAW))
def merge_joint_has_sensor(spark, sf_dir):
    return _merged(spark, sf_dir, GB.merge_joint_has_sensor, "merge_joint_has_sensor")


@register("merge_environment_reading", sql=graph_sql(
    "SELECT hasTimestamp, hasAirQuality, hasHumidity, round(hasTemperature, 6) AS hasTemperature "
    "FROM es", ES_SQL))
def merge_environment_reading(spark, sf_dir):
    out = _merged(spark, sf_dir, GB.merge_environment_reading, "merge_environment_reading")
    return out.withColumn("hasTemperature", F.round("hasTemperature", 6))


@register("merge_has_reading", sql=with_telemetry("SELECT * FROM hrd", HRD_SQL))
def merge_has_reading(spark, sf_dir):
    return _merged(spark, sf_dir, GB.merge_has_reading, "merge_has_reading")


# --- M9 / M10: last-write-wins summaries over the window aggregates, with their anchors -----
def anchored(summary: DataFrame, seed: DataFrame, label: str, edge: str) -> DataFrame:
    """MATCH the anchor node, then its relationship to each summary node; without the anchor nothing.

    The seed's size is fixed, so its one matching row is broadcast.
    """
    anchor = seed.filter((F.col("label") == label) & (F.col("name") == label)).select(F.col("name").alias("src"))
    keyed = summary.withColumn("_a", F.lit(label))
    return (keyed.join(F.broadcast(anchor), F.col("_a") == F.col("src")).drop("_a")
            .withColumn("edge", F.lit(edge)))


@register("summary_log_latest", sql=with_telemetry(f"""
SELECT log_type AS logType, arg_max(log_count, ws) AS count, max(ws) AS timestamp, 'Log' AS src, 'HAS_LOG_SUMMARY' AS edge FROM (
  SELECT {WS_SQL} AS ws, log_type, count(log_type) AS log_count FROM telemetry GROUP BY 1, 2) w
WHERE log_type IS NOT NULL GROUP BY log_type"""))
def summary_log_latest(spark, sf_dir):
    """LogSummary per log type: the latest window's count wins (SET outside ON CREATE)."""
    w = W.window_log_counts(telemetry(spark, sf_dir), ts="ts")
    rows = w.filter(F.col("log_type").isNotNull()).select(
        F.col("log_type").alias("logType"), F.col("log_count").alias("count"),
        F.col("window_start").alias("timestamp"))
    return anchored(G.upsert_latest(rows, None, ["logType"], ["timestamp"]), GB.seed_nodes(spark), "Log", "HAS_LOG_SUMMARY")


@register("summary_env_latest", sql=with_telemetry(f"""
SELECT round(arg_max(avg_humidity, ws), 6) AS avg_humidity, max(ws) AS timestamp, 'Environment' AS src, 'HAS_ENV_SUMMARY' AS edge FROM (
  SELECT {WS_SQL} AS ws, avg(TRY_CAST(environment_humidity AS DOUBLE)) AS avg_humidity
  FROM telemetry GROUP BY 1) w"""))
def summary_env_latest(spark, sf_dir):
    """The single EnvironmentSummary node after all window upserts (latest wins)."""
    w = W.window_avg_humidity(telemetry(spark, sf_dir), ts="ts")
    rows = w.select("avg_humidity", F.col("window_start").alias("timestamp"))
    out = G.upsert_latest(rows, None, [], ["timestamp"]).select(F.round("avg_humidity", 6).alias("avg_humidity"), "timestamp")
    return anchored(out, GB.seed_nodes(spark), "Environment", "HAS_ENV_SUMMARY")


# --- M11 / U2: UNWIND events -> CREATE many nodes per event --------------------------------
def _unwind_sql() -> str:
    """One struct for each property of each node, and for each relationship."""
    def cell(kind, label, name, prop, value):
        return "{{'kind': '{}', 'label': '{}', 'name': '{}', 'prop': {}, 'value': {}}}".format(kind, label, name, prop, value)

    null = "CAST(NULL AS VARCHAR)"
    items = []
    for lbl, name, props in fixed.UNWIND_NODES:
        items.append(cell("node", lbl, name, null, null))
        for k, v in props.items():
            number = v in _NUMBERS
            items.append(cell("prop", lbl, name, f"'{k}'", f"printf('%.6f', {v})" if number else
                              f"strftime({v}, '%Y-%m-%d %H:%M:%S.%f')" if k == "hasTimestamp" else f"CAST({v} AS VARCHAR)"))
    items += [cell("edge", t, f"{a}->{b}", null, null) for t, a, b in fixed.UNWIND_EDGES]
    return with_telemetry(f"""
SELECT event_id, n.kind AS kind, n.label AS label, n.name AS name, n.prop AS prop, n.value AS value
FROM (SELECT event_id, unnest([{", ".join(items)}]) AS n FROM telemetry) x""")


_NUMBERS = ("joint_angle", "current", "force_x", "position_x", "position_y", "position_z", "torque_y", "velocity",
            "environment_temperature")


@register("unwind_create", sql=_unwind_sql())
def unwind_create(spark, sf_dir):
    """Each event creates 15 nodes, their properties and the 14 relationships between them (no
    dedup): an ``inline`` of per-row structs - a narrow flat-map, no shuffle; the output is one
    row for each node, property and relationship."""
    def cell(kind, label, name, prop=None, value=None):
        text = F.lit(None).cast("string")
        return F.struct(F.lit(kind).alias("kind"), F.lit(label).alias("label"), F.lit(name).alias("name"),
                        (F.lit(prop) if prop else text).alias("prop"), (text if value is None else value).alias("value"))

    def shown(prop, expr):
        if expr in _NUMBERS:
            return F.format_string("%.6f", F.expr(expr))
        return F.date_format(F.expr(expr), "yyyy-MM-dd HH:mm:ss.SSSSSS") if prop == "hasTimestamp" else F.expr(expr).cast("string")

    cells = []
    for lbl, name, props in fixed.UNWIND_NODES:
        cells += [cell("node", lbl, name), *[cell("prop", lbl, name, k, shown(k, v)) for k, v in props.items()]]
    cells += [cell("edge", t, f"{a}->{b}") for t, a, b in fixed.UNWIND_EDGES]
    return telemetry(spark, sf_dir).select("event_id", F.inline(F.array(*cells)))


# --- K6: append rows as labelled nodes, no dedup -----------------------------------------
@register("append_label_nodes", sql=with_telemetry("""
SELECT 'sensor' AS label, sensor_name, ts AS timestamp, round(environment_temperature, 6) AS temperature
FROM telemetry"""))
def append_label_nodes(spark, sf_dir):
    tel = telemetry(spark, sf_dir).select(
        "sensor_name", F.col("ts").alias("timestamp"),
        F.round("environment_temperature", 6).alias("temperature"))
    root = scratch_path(spark, "nodes")
    append_nodes(tel, root, "sensor")
    return spark.read.parquet(root).filter(F.col("label") == "sensor").select(
        "label", "sensor_name", "timestamp", "temperature")


# --- M12 / X7: back-fill an Unhealthy reading for every error instant ----------------------
@register("backfill_unhealthy", sql=graph_sql("""
SELECT coalesce(es.hasTimestamp, e.ts) AS hasTimestamp,
       CASE WHEN e.ts IS NOT NULL THEN 'Unhealthy' ELSE es.hasAirQuality END AS hasAirQuality,
       e.ts IS NOT NULL AS backfilled,
       CASE WHEN e.ts IS NOT NULL THEN true END AS in_range,
       (hrd.env_name IS NOT NULL OR e.ts IS NOT NULL) AS linked
FROM es FULL OUTER JOIN (SELECT DISTINCT timestamp AS ts FROM ln WHERE name = 'error') e
  ON es.hasTimestamp = e.ts LEFT JOIN hrd ON hrd.es_timestamp = coalesce(es.hasTimestamp, e.ts)""", LN_SQL, ES_SQL, HRD_SQL))
def backfill_unhealthy(spark, sf_dir):
    """Readings after the back-fill; random humidity / temperature replaced by a range check."""
    tg = _graph(spark, sf_dir)
    out = backfill(tg.environment_sensor, tg.log_notification)
    in_range = ((F.col("hasHumidity").try_cast("double") >= 0) & (F.col("hasHumidity").try_cast("double") < 100)
                & (F.col("hasTemperature") >= 15) & (F.col("hasTemperature") < 25))
    links = backfill_links(tg.has_reading, out).select(F.col("es_timestamp").alias("hasTimestamp"), F.lit(True).alias("linked"))
    return (out.join(links.distinct(), "hasTimestamp", "left")
            .select("hasTimestamp", "hasAirQuality", "backfilled", F.when(F.col("backfilled"), in_range).alias("in_range"),
                    F.coalesce("linked", F.lit(False)).alias("linked")))


def backfill_links(has_reading: DataFrame, filled: DataFrame) -> DataFrame:
    """MERGE of Environment-[:HAS_READING]->(reading) for every back-filled reading."""
    new = filled.filter("backfilled").select(F.lit("Environment").alias("env_name"), F.col("hasTimestamp").alias("es_timestamp"),
                                             F.col("hasTimestamp").alias("timestamp"))
    keys = ["env_name", "es_timestamp"]
    return has_reading.unionByName(new.join(has_reading.select(*keys), keys, "left_anti"))


def backfill(readings: DataFrame, notifications: DataFrame, seed: int = 42) -> DataFrame:
    """MERGE an EnvironmentSensor per error instant and SET Unhealthy + random values.

    The error instants are joined, not collected: a full outer join keeps
    readings without errors unchanged and creates readings for new instants.
    """
    errs = (notifications.filter(F.col("name") == "error")
            .select(F.col("timestamp").alias("_ets")).distinct())
    j = readings.join(errs, readings.hasTimestamp == errs._ets, "full_outer")
    hit = F.col("_ets").isNotNull()
    return j.select(
        F.coalesce("hasTimestamp", "_ets").alias("hasTimestamp"),
        F.when(hit, F.lit("Unhealthy")).otherwise(F.col("hasAirQuality")).alias("hasAirQuality"),
        F.when(hit, (_unit(seed) * 100).cast("string")).otherwise(F.col("hasHumidity")).alias("hasHumidity"),
        F.when(hit, F.lit(15.0) + _unit(seed + 1) * 10).otherwise(F.col("hasTemperature")).alias("hasTemperature"),
        hit.alias("backfilled"))


def _unit(seed: int):
    """A value in [0, 1) that depends on the instant and the seed alone, so a retried task repeats it."""
    return F.pmod(F.xxhash64("_ets", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


# --- M13: bounded DETACH DELETE ---------------------------------------------------------
DELETE_LIMIT = 40000


@register("detach_delete", sql=graph_sql(f"""
SELECT (SELECT count(*) FROM v) AS deleted_nodes,
       (SELECT count(*) FROM hs WHERE sensor_timestamp IN (SELECT timestamp FROM v)) AS deleted_edges,
       (SELECT count(*) FROM sensor) - (SELECT count(*) FROM v) AS remaining_nodes,
       (SELECT count(*) FROM hs WHERE sensor_timestamp NOT IN (SELECT timestamp FROM v)) AS remaining_edges
""", SENSOR_SQL, HS_SQL, f"v AS (SELECT timestamp FROM sensor ORDER BY timestamp LIMIT {DELETE_LIMIT})"))
def detach_delete(spark, sf_dir):
    """Pick the first 40 000 Sensor nodes, delete them and their HAS_SENSOR edges."""
    tg = _graph(spark, sf_dir)
    sensors, hs = tg.sensor, tg.has_sensor
    # an ordered limit of a fixed size: bounded, so broadcasting it is safe
    victims = F.broadcast(sensors.select("timestamp").orderBy("timestamp").limit(DELETE_LIMIT))
    kept_nodes, kept = G.detach_delete(sensors, "timestamp",
                                       {"has_sensor": (hs, ["sensor_timestamp"])}, victims)
    tagged = (sensors.select(F.lit("n_all").alias("k"))
              .unionByName(hs.select(F.lit("e_all").alias("k")))
              .unionByName(kept_nodes.select(F.lit("n_kept").alias("k")))
              .unionByName(kept["has_sensor"].select(F.lit("e_kept").alias("k"))))
    c = {k: F.count_if(F.col("k") == k) for k in ["n_all", "e_all", "n_kept", "e_kept"]}
    return tagged.agg((c["n_all"] - c["n_kept"]).alias("deleted_nodes"),
                      (c["e_all"] - c["e_kept"]).alias("deleted_edges"),
                      c["n_kept"].alias("remaining_nodes"), c["e_kept"].alias("remaining_edges"))


# --- M13 on the kept graph: tombstones ---------------------------------------------------
@register("store_delete", sql=graph_sql("""
SELECT 'sensor' AS tbl, '' AS name, timestamp FROM sensor WHERE timestamp NOT IN (SELECT timestamp FROM v)
UNION ALL SELECT 'has_sensor', joint_name, sensor_timestamp FROM hs WHERE sensor_timestamp NOT IN (SELECT timestamp FROM v)
UNION ALL SELECT 'log_notification', name, timestamp FROM ln
UNION ALL SELECT 'deleted', '', timestamp FROM v WHERE timestamp IN (SELECT min(timestamp) FROM v UNION SELECT max(timestamp) FROM v)
""", SENSOR_SQL, HS_SQL, LN_SQL, "v AS (SELECT timestamp FROM sensor ORDER BY timestamp LIMIT (SELECT count(*) * 2 // 5 FROM sensor))"))
def store_delete(spark, sf_dir):
    """The first two fifths of the Sensor nodes (40 000 of 100 000) and their edges are deleted from a stored graph,
    twice under the same name (the second run changes nothing); what remains is read back, with the first and
    last key deleted."""
    store = _graph(spark, sf_dir).store.compact_to(scratch_path(spark, "delete"))
    n = store.read("sensor").count()
    for _ in range(2):
        victims = store.read("sensor").select("timestamp").orderBy("timestamp").limit(n * 2 // 5)
        store.delete("sensor", victims, "oldest")
    left = StoredGraph(GraphStore(spark, store.root))
    ends = store.tombstones("sensor").agg(F.min("timestamp"), F.max("timestamp"))
    gone = ends.select(F.explode(F.array_distinct(F.array(*ends.columns))).alias("timestamp")).filter("timestamp is not null")
    ts = F.col("timestamp").cast("timestamp_ntz").alias("timestamp")
    return (left.sensor.select(F.lit("sensor").alias("tbl"), F.lit("").alias("name"), ts)
            .unionByName(left.has_sensor.select(F.lit("has_sensor").alias("tbl"), F.col("joint_name").alias("name"),
                                                F.col("sensor_timestamp").cast("timestamp_ntz").alias("timestamp")))
            .unionByName(left.log_notification.select(F.lit("log_notification").alias("tbl"), "name", ts))
            .unionByName(gone.select(F.lit("deleted").alias("tbl"), F.lit("").alias("name"), ts)))
