"""Window aggregates, graph reads, anomaly correlation and dashboard reports.

The window aggregates read the telemetry proxy (built from ``events``); the graph
reports read the stored node and edge tables that the ingest job keeps.  The seed
topology (Thing -> RobotArm -> Log, Thing -> Environment, joints) is a stored table of
fixed size and is joined by broadcast; all data-sized joins are left to AQE
(broadcast only when measured small, else shuffle; skewed partitions split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.telemetry import air_quality_category, air_quality_level, trunc_ntz
from ..operators import windows as W
from ..operators.patterns import one_hop
from ..session import scratch_path
from ..sources.tables import tables_state
from ..streaming.graph_store import GraphStore, StoredGraph
from . import graph_build as GB
from .proxy import telemetry, with_telemetry
from .registry import register

R6 = 6  # digits kept when comparing doubles across engines

# 5-minute tumbling window start in DuckDB (Spark's window() is epoch aligned).
WS_SQL = "date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 5 AS BIGINT))"


_STORED: dict[tuple, str] = {}


def _graph(spark: SparkSession, sf_dir: str) -> StoredGraph:
    """The graph that the ingest job keeps, with its seed; stored once per application and state of the table's files."""
    key = (spark.sparkContext.applicationId, tables_state(spark, sf_dir, ["events"]))
    store = GraphStore(spark, _STORED.get(key) or scratch_path(spark, "graph"))
    if key not in _STORED:
        store.seed()
        store.upsert_batch(telemetry(spark, sf_dir), 0)
        _STORED[key] = store.root
    return StoredGraph(store)


# key -> fn(spark, graph): the graph reports, runnable over any object exposing the
# node / edge tables (``TelemetryGraph`` built from telemetry, or a ``GraphStore``'s
# stored tables via ``StoredGraph``)
REPORTS = {}


def report(key: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        REPORTS[key] = fn

        def query(spark, sf_dir):
            return fn(spark, _graph(spark, sf_dir))
        query.__name__, query.__doc__ = fn.__name__, fn.__doc__
        register(key, sql=sql, headline=headline)(query)
        return fn
    return deco


def _rel(tg, etype, src_label, dst_label, a, b) -> DataFrame:
    return (tg.seed_edges.filter((F.col("type") == etype) & (F.col("src_label") == src_label)
                                 & (F.col("dst_label") == dst_label))
            .select(F.col("src_name").alias(a), F.col("dst_name").alias(b)))


def topology_logs(tg) -> DataFrame:
    """(thing, robot, log) for Thing-HAS_A->RobotArm-HAS_LOGS->Log."""
    return _rel(tg, "HAS_A", "Thing", "RobotArm", "thing", "robot").join(
        _rel(tg, "HAS_LOGS", "RobotArm", "Log", "robot", "log"), "robot")


def topology_envs(tg) -> DataFrame:
    return _rel(tg, "HAS_A", "Thing", "Environment", "thing", "env")


def topology_joints(tg) -> DataFrame:
    return _rel(tg, "HAS_A", "Thing", "RobotArm", "thing", "robot").join(
        _rel(tg, "HAS_JOINT", "RobotArm", "Joint", "robot", "joint"), "robot")


def attach(df: DataFrame, topology: DataFrame, on: list[str]) -> DataFrame:
    """Join with matches of a pattern over the seed: the seed's size is fixed (tens of rows), so it is broadcast."""
    return df.join(F.broadcast(topology), on)


def _r(c: str, alias: str | None = None):
    return F.round(F.col(c), R6).alias(alias or c)


# --- A1 / A2 / A14: windowed aggregates (batch) ----------------------------------
@register("win_log_counts", headline=True, sql=with_telemetry(f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, log_type,
       count(log_type) AS log_count
FROM (SELECT {WS_SQL} AS ws, log_type FROM telemetry) t
GROUP BY ws, log_type"""))
def win_log_counts(spark, sf_dir):
    return W.window_log_counts(telemetry(spark, sf_dir), ts="ts")


@register("win_avg_humidity", headline=True, sql=with_telemetry(f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end,
       round(avg(TRY_CAST(environment_humidity AS DOUBLE)), 6) AS avg_humidity
FROM (SELECT {WS_SQL} AS ws, environment_humidity FROM telemetry) t
GROUP BY ws"""))
def win_avg_humidity(spark, sf_dir):
    out = W.window_avg_humidity(telemetry(spark, sf_dir), ts="ts")
    return out.select("window_start", "window_end", _r("avg_humidity"))


@register("win_temperature_stats", sql=with_telemetry(f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end,
       round(min(environment_temperature), 6) AS min_temperature,
       round(max(environment_temperature), 6) AS max_temperature,
       round(avg(environment_temperature), 6) AS avg_temperature
FROM (SELECT {WS_SQL} AS ws, environment_temperature FROM telemetry) t
GROUP BY ws"""))
def win_temperature_stats(spark, sf_dir):
    out = W.window_temperature_stats(telemetry(spark, sf_dir), ts="ts")
    return out.select("window_start", "window_end", _r("min_temperature"),
                      _r("max_temperature"), _r("avg_temperature"))


# Graph tables in DuckDB (first row per key by event_id = first write wins), over all
# records (``_RAW``) or over the first record of each instant, as the ingest keeps them.
FIRST_SQL = """d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY obs_ts ORDER BY event_id) AS rn
                 FROM telemetry WHERE obs_ts IS NOT NULL) x WHERE rn = 1)"""
LN_RAW = """ln AS (
  SELECT log_type AS name, obs_ts AS timestamp, log_message AS hasMessage FROM (
    SELECT *, row_number() OVER (PARTITION BY log_type, obs_ts ORDER BY event_id) AS rn
    FROM telemetry WHERE log_type IS NOT NULL AND obs_ts IS NOT NULL) x WHERE rn = 1)"""
HR_RAW = """hr AS (SELECT DISTINCT 'Log' AS log_name, log_type AS ln_name, obs_ts AS ln_timestamp,
  obs_ts AS timestamp FROM telemetry WHERE log_type IS NOT NULL AND obs_ts IS NOT NULL)"""
HS_RAW = """hs AS (SELECT DISTINCT joint_name, obs_ts AS sensor_timestamp, obs_ts AS timestamp
  FROM telemetry WHERE joint_name IS NOT NULL AND obs_ts IS NOT NULL)"""
_ES = """es AS (SELECT obs_ts AS hasTimestamp, environment_air_quality AS hasAirQuality,
  environment_humidity AS hasHumidity, environment_temperature AS hasTemperature FROM d)"""
_SENSOR = """sensor AS (
  SELECT obs_ts AS timestamp, joint_angle AS hasAcceleration, current AS hasCurrent,
    force_x AS hasForceX, force_y AS hasForceY, force_z AS hasForceZ,
    position_x AS hasPositionX, position_y AS hasPositionY, position_z AS hasPositionZ,
    torque_x AS hasTorqueX, torque_y AS hasTorqueY, torque_z AS hasTorqueZ,
    velocity AS hasVelocity FROM d)"""
# keyed on the timestamp alone, so the same with and without the ingest's deduplication
LN_SQL = """ln AS (SELECT log_type AS name, obs_ts AS timestamp, log_message AS hasMessage
  FROM d WHERE log_type IS NOT NULL)"""
HR_SQL = """hr AS (SELECT 'Log' AS log_name, log_type AS ln_name, obs_ts AS ln_timestamp, obs_ts AS timestamp
  FROM d WHERE log_type IS NOT NULL)"""
HS_SQL = """hs AS (SELECT joint_name, obs_ts AS sensor_timestamp, obs_ts AS timestamp
  FROM d WHERE joint_name IS NOT NULL)"""
HRD_SQL = """hrd AS (SELECT DISTINCT 'Environment' AS env_name, obs_ts AS es_timestamp,
  obs_ts AS timestamp FROM telemetry WHERE obs_ts IS NOT NULL)"""
ES_SQL, SENSOR_SQL = _ES, _SENSOR


def graph_sql(body: str, *ctes: str) -> str:
    """A DuckDB query over tables of the ingested graph."""
    return with_telemetry(body, FIRST_SQL, *ctes)


def _ln_edges(spark, tg) -> DataFrame:
    """Log-[:HAS_RECORD]->LogNotification rows: (log, ln_name, ln_timestamp, ln_message, edge_ts)."""
    ln = tg.log_notification.select(F.col("name").alias("ln_name"),
                                    F.col("timestamp").alias("ln_timestamp"),
                                    F.col("hasMessage").alias("ln_message"))
    hr = tg.has_record.select(F.col("log_name").alias("log"), "ln_name", "ln_timestamp",
                              F.col("timestamp").alias("edge_timestamp"))
    return hr.join(ln, ["ln_name", "ln_timestamp"])


def _es_edges(spark, tg) -> DataFrame:
    es = tg.environment_sensor.withColumnRenamed("hasTimestamp", "es_timestamp")
    hrd = tg.has_reading.select(F.col("env_name").alias("env"), "es_timestamp")
    return hrd.join(es, "es_timestamp")


# --- J1: one-hop pattern ----------------------------------------------------------
@report("match_one_hop", sql=graph_sql("""
SELECT hr.log_name AS log, hr.ln_name, hr.ln_timestamp, ln.hasMessage AS ln_message,
       hr.timestamp AS edge_timestamp
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp""", LN_SQL, HR_SQL))
def match_one_hop(spark, tg):
    """(log:Log)-[r:HAS_RECORD]->(ln:LogNotification): one row per edge."""
    logs = tg.seed_nodes.filter(F.col("label") == "Log").select("name")
    ln = tg.log_notification.select("name", "timestamp", F.col("hasMessage").alias("ln_message"))
    edges = tg.has_record.select(F.col("log_name").alias("log"), "ln_name", "ln_timestamp", F.col("timestamp").alias("edge_timestamp"))
    hops = one_hop(F.broadcast(logs), ["name"], edges, ["log"], ["ln_name", "ln_timestamp"], ln, ["name", "timestamp"])
    return hops.select("log", "ln_name", "ln_timestamp", "ln_message", "edge_timestamp")


# --- D4 / J3 / J4: error notification coinciding with unhealthy air ----------------
_ANOMALY = """
SELECT 'Thing' AS thing, 'RobotArm' AS robot, 'Log' AS log, ln.name AS ln_name,
       ln.timestamp AS ln_timestamp, ln.hasMessage AS ln_message, 'Environment' AS env,
       es.hasTimestamp AS es_timestamp, es.hasAirQuality AS es_air_quality,
       es.hasHumidity AS es_humidity, round(es.hasTemperature, 6) AS es_temperature
FROM ln JOIN hr ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp
JOIN es ON es.hasTimestamp = ln.timestamp
JOIN hrd ON hrd.es_timestamp = es.hasTimestamp
WHERE ln.name = 'error' AND es.hasAirQuality = 'Unhealthy'"""


@report("anomaly_env_error", headline=True, sql=graph_sql(_ANOMALY, LN_SQL, HR_SQL, ES_SQL, HRD_SQL))
def anomaly_env_error(spark, tg):
    """All matches (the report showed the first one); the error filter runs before the join."""
    topo = topology_logs(tg).join(topology_envs(tg), "thing")
    ln = _ln_edges(spark, tg).filter(F.col("ln_name") == "error")
    es = _es_edges(spark, tg).filter(F.col("hasAirQuality") == "Unhealthy")
    j = attach(ln.join(es, ln.ln_timestamp == es.es_timestamp), topo, ["log", "env"])
    return j.select("thing", "robot", "log", "ln_name", "ln_timestamp", "ln_message", "env",
                    "es_timestamp", F.col("hasAirQuality").alias("es_air_quality"),
                    F.col("hasHumidity").alias("es_humidity"),
                    F.round("hasTemperature", R6).alias("es_temperature"))


@report("anomaly_env_error_first", sql=graph_sql(_ANOMALY + " ORDER BY ln.timestamp LIMIT 1", LN_SQL, HR_SQL, ES_SQL, HRD_SQL))
def anomaly_env_error_first(spark, tg, limit: int = 1):
    """The report as shown: the first ``limit`` matches by time (one match an instant)."""
    return anomaly_env_error(spark, tg).orderBy("ln_timestamp").limit(limit)


# --- J5: error notification x joint sensor at the same instant --------------------
@report("anomaly_joint_error", sql=graph_sql("""
SELECT ln.timestamp AS logTimestamp, ln.hasMessage AS logMessage, hs.joint_name AS jointName,
       round(s.hasAcceleration, 6) AS acceleration, round(s.hasCurrent, 6) AS current,
       round(s.hasForceX, 6) AS forceX, round(s.hasForceY, 6) AS forceY,
       round(s.hasForceZ, 6) AS forceZ, round(s.hasPositionX, 6) AS positionX,
       round(s.hasPositionY, 6) AS positionY, round(s.hasPositionZ, 6) AS positionZ
FROM ln JOIN hr ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp
JOIN sensor s ON s.timestamp = ln.timestamp
JOIN hs ON hs.sensor_timestamp = s.timestamp
WHERE ln.name = 'error'""", LN_SQL, HR_SQL, SENSOR_SQL, HS_SQL))
def anomaly_joint_error(spark, tg):
    topo = topology_joints(tg).join(topology_logs(tg), ["thing", "robot"])
    ln = _ln_edges(spark, tg).filter(F.col("ln_name") == "error")
    s = tg.sensor
    hs = tg.has_sensor.select(F.col("joint_name").alias("joint"), "sensor_timestamp")
    sens = hs.join(s, hs.sensor_timestamp == s.timestamp)
    j = attach(ln.join(sens, ln.ln_timestamp == sens.timestamp), topo, ["joint", "log"])
    return j.select(
        F.col("ln_timestamp").alias("logTimestamp"), F.col("ln_message").alias("logMessage"),
        F.col("joint").alias("jointName"), _r("hasAcceleration", "acceleration"),
        _r("hasCurrent", "current"), _r("hasForceX", "forceX"), _r("hasForceY", "forceY"),
        _r("hasForceZ", "forceZ"), _r("hasPositionX", "positionX"),
        _r("hasPositionY", "positionY"), _r("hasPositionZ", "positionZ")).orderBy("logTimestamp", "jointName")


# --- A3: errors per hour -----------------------------------------------------------
@report("errors_per_hour", headline=True, sql=graph_sql("""
SELECT date_trunc('hour', ln.timestamp) AS hour, count(*) AS errorCount
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp
WHERE ln.name = 'error' GROUP BY 1""", LN_SQL, HR_SQL))
def errors_per_hour(spark, tg):
    ln = _ln_edges(spark, tg).filter(F.col("ln_name") == "error")
    return (ln.groupBy(trunc_ntz("hour", "ln_timestamp").alias("hour"))
            .agg(F.count("*").alias("errorCount"))
            .orderBy(F.col("hour").asc_nulls_last()))


# --- A4 / U3: distinct notifications per minute -------------------------------------
@report("notifications_per_minute", sql=graph_sql("""
SELECT date_trunc('minute', ln.timestamp) AS minute,
       count(DISTINCT (ln.name, ln.timestamp)) AS totalErrorCount
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp GROUP BY 1""",
                                                   LN_SQL, HR_SQL))
def notifications_per_minute(spark, tg, approx: bool = False, rsd: float = 0.01):
    """Counts every notification (the report's name says errors, its query has no filter).

    ``approx=True`` replaces the exact distinct count (a second aggregation level)
    with a HyperLogLog sketch of fixed size per group (relative error ``rsd``)."""
    ln = _ln_edges(spark, tg)
    if approx:
        n = F.approx_count_distinct(F.struct("ln_name", "ln_timestamp"), rsd)
    else:
        n = F.count_distinct("ln_name", "ln_timestamp")
    return (ln.groupBy(trunc_ntz("minute", "ln_timestamp").alias("minute"))
            .agg(n.alias("totalErrorCount"))
            .orderBy(F.col("minute").asc_nulls_last()))


# --- A4 rolled up: mergeable distinct counts ------------------------------------------
SKETCH_BITS = 12


def minute_sketches(links: DataFrame) -> DataFrame:
    """(minute, sketch, exact): a sketch of fixed size of the distinct notifications of each minute, beside their count."""
    return (links.groupBy(trunc_ntz("minute", "ln_timestamp").alias("minute"))
            .agg(F.hll_sketch_agg(F.xxhash64("ln_name", "ln_timestamp"), SKETCH_BITS).alias("sketch"),
                 F.count_distinct("ln_name", "ln_timestamp").alias("exact")))


def rolled_up(minutes: DataFrame, unit: str) -> DataFrame:
    """(bucket, estimate): the sketches of a unit's minutes merged; no row of the graph is read again."""
    return minutes.groupBy(trunc_ntz(unit, "minute").alias("bucket")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


_ROLLUP = " UNION ALL ".join(f"""
SELECT '{u}' AS unit, date_trunc('{u}', ln.timestamp) AS bucket, count(DISTINCT (ln.name, ln.timestamp)) AS exact, true AS close
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp GROUP BY 2""" for u in ("minute", "hour", "day"))


@report("notifications_rollup", sql=graph_sql(_ROLLUP, LN_SQL, HR_SQL))
def notifications_rollup(spark, tg):
    """Distinct notifications by minute, hour and day: the exact counts, and whether the merged sketches' estimates
    are as close as sketches of this size are (1.04 / sqrt(2**bits), four times over)."""
    links = _ln_edges(spark, tg)
    path = scratch_path(spark, "sketches")
    minute_sketches(links).write.parquet(path)
    minutes, out = spark.read.parquet(path), None
    for unit in ("minute", "hour", "day"):
        exact = links.groupBy(trunc_ntz(unit, "ln_timestamp").alias("bucket")).agg(F.count_distinct("ln_name", "ln_timestamp").alias("exact"))
        near = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * F.lit(4 * 1.04 / 2 ** (SKETCH_BITS / 2)) + 1
        rows = exact.join(rolled_up(minutes, unit), "bucket").select(F.lit(unit).alias("unit"), "bucket", "exact", near.alias("close"))
        out = rows if out is None else out.unionByName(rows)
    return out


# --- A5: count per log type -----------------------------------------------------------
@report("logs_by_type", headline=True, sql=graph_sql("""
SELECT ln.name AS logType, count(*) AS count
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp GROUP BY 1""",
                                                            LN_SQL, HR_SQL))
def logs_by_type(spark, tg):
    return (_ln_edges(spark, tg).groupBy(F.col("ln_name").alias("logType"))
            .agg(F.count("*").alias("count")).orderBy(F.desc("count"), "logType"))


# --- A6 / A13 / X3 / X5: averages per air-quality category -------------------------------
@report("env_avg_by_quality", headline=True, sql=graph_sql("""
SELECT CASE WHEN hasAirQuality = 'Good' THEN 'Good' WHEN hasAirQuality = 'Moderate' THEN 'Moderate'
            WHEN hasAirQuality = 'Unhealthy' THEN 'Unhealthy' ELSE 'Other' END AS category,
       round(avg(TRY_CAST(hasHumidity AS DOUBLE)), 6) AS avgHumidity,
       round(avg(TRY_CAST(hasTemperature AS DOUBLE)), 6) AS avgTemperature
FROM es JOIN hrd ON hrd.es_timestamp = es.hasTimestamp GROUP BY 1""", ES_SQL, HRD_SQL))
def env_avg_by_quality(spark, tg):
    es = attach(_es_edges(spark, tg), topology_envs(tg), ["env"])
    g = es.groupBy(air_quality_category("hasAirQuality").alias("category")).agg(
        F.avg(F.col("hasHumidity").try_cast("double")).alias("avgHumidity"),
        F.avg(F.col("hasTemperature").try_cast("double")).alias("avgTemperature"))
    return g.select("category", _r("avgHumidity"), _r("avgTemperature"))


# --- F4 / J6 / A7: readings at notification instants, counted per category ----------------
@report("env_quality_during_notifications", sql=graph_sql("""
SELECT CASE WHEN hasAirQuality = 'Good' THEN 'Good' WHEN hasAirQuality = 'Moderate' THEN 'Moderate'
            WHEN hasAirQuality = 'Unhealthy' THEN 'Unhealthy' ELSE 'Other' END AS category,
       count(*) AS errorCount
FROM es JOIN hrd ON hrd.es_timestamp = es.hasTimestamp
WHERE es.hasTimestamp IN (SELECT ln.timestamp FROM hr JOIN ln
                          ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp)
GROUP BY 1""", LN_SQL, HR_SQL, ES_SQL, HRD_SQL))
def env_quality_during_notifications(spark, tg):
    """``IN collect(...)`` as a semi-join: nothing is collected into one list."""
    times = _ln_edges(spark, tg).select(F.col("ln_timestamp").alias("es_timestamp"))
    es = _es_edges(spark, tg).join(times, "es_timestamp", "left_semi")
    return (es.groupBy(air_quality_category("hasAirQuality").alias("category"))
            .agg(F.count("*").alias("errorCount")).orderBy("category"))


# --- A10: the error-notification instants (the collected list, as rows) --------------------
@report("collect_error_times", sql=graph_sql("""
SELECT ln.timestamp AS errorTimestamp
FROM hr JOIN ln ON hr.ln_name = ln.name AND hr.ln_timestamp = ln.timestamp
WHERE ln.name = 'error'""", LN_SQL, HR_SQL))
def collect_error_times(spark, tg):
    return (_ln_edges(spark, tg).filter(F.col("ln_name") == "error")
            .select(F.col("ln_timestamp").alias("errorTimestamp")).orderBy("errorTimestamp"))


# --- J2 / A8 / F3 / X6: average joint position per instant ----------------------------------
def _joint_position_sql(joint: str) -> str:
    return graph_sql(f"""
SELECT coalesce(hs.timestamp, s.timestamp) AS timestamp,
       round(avg(s.hasPositionX), 6) AS positionX, round(avg(s.hasPositionY), 6) AS positionY,
       round(avg(s.hasPositionZ), 6) AS positionZ
FROM hs JOIN sensor s ON hs.sensor_timestamp = s.timestamp
WHERE hs.joint_name = '{joint}'
  AND coalesce(hs.timestamp, s.timestamp) <> TIMESTAMP '{fixed.SEED_TIMESTAMP}'
GROUP BY 1""", SENSOR_SQL, HS_SQL)


def joint_position(spark, tg, joint: str) -> DataFrame:
    topo = topology_joints(tg).filter(F.col("joint") == joint)
    hs = (tg.has_sensor.filter(F.col("joint_name") == joint)
          .select(F.col("joint_name").alias("joint"), "sensor_timestamp",
                  F.col("timestamp").alias("edge_timestamp")))
    s = tg.sensor
    j = attach(hs, topo, ["joint"]).join(s, hs.sensor_timestamp == s.timestamp)
    t = F.coalesce(F.col("edge_timestamp"), F.col("timestamp"))
    seed_ts = F.lit(fixed.SEED_TIMESTAMP).cast("timestamp_ntz")
    g = (j.filter(t != seed_ts).groupBy(t.alias("ts"))
         .agg(F.avg("hasPositionX").alias("positionX"), F.avg("hasPositionY").alias("positionY"),
              F.avg("hasPositionZ").alias("positionZ")))
    return g.select(F.col("ts").alias("timestamp"), _r("positionX"), _r("positionY"),
                    _r("positionZ")).orderBy(F.col("timestamp").asc_nulls_last())


@report("report_joint_position", headline=True, sql=_joint_position_sql("joint_1"))
def report_joint_position(spark, tg):
    return joint_position(spark, tg, "joint_1")


@report("report_joint2_position", sql=_joint_position_sql("joint_2"))
def report_joint2_position(spark, tg):
    return joint_position(spark, tg, "joint_2")


# --- F3 where it matters: readings at the seed instant ----------------------------------
def _seeded_sql(joint: str) -> str:
    return with_telemetry(f"""
SELECT timestamp, round(avg(hasPositionX), 6) AS positionX, round(avg(hasPositionY), 6) AS positionY, round(avg(hasPositionZ), 6) AS positionZ
FROM (SELECT CASE WHEN obs_ts IN (SELECT obs_ts FROM d WHERE joint_name = '{joint}' ORDER BY obs_ts LIMIT 3) AND joint_name = '{joint}'
             THEN TIMESTAMP '{fixed.SEED_TIMESTAMP}' ELSE obs_ts END AS timestamp, joint_name,
             position_x AS hasPositionX, position_y AS hasPositionY, position_z AS hasPositionZ FROM d) x
WHERE joint_name = '{joint}' AND timestamp <> TIMESTAMP '{fixed.SEED_TIMESTAMP}' GROUP BY 1""", FIRST_SQL)


@register("report_joint_position_seeded", sql=_seeded_sql("joint_1"))
def report_joint_position_seeded(spark, sf_dir):
    """The joint's report over a graph whose first three readings of the joint stand at the seed instant, as a
    seed with example readings has them: the filter leaves these out, and they are in the tables that it reads."""
    seed_ts = F.lit(fixed.SEED_TIMESTAMP).cast("timestamp_ntz")
    tel = GB.dedup_timestamp(telemetry(spark, sf_dir))
    first = tel.filter(F.col("joint_name") == "joint_1").select(F.col("obs_ts").alias("_at")).orderBy("_at").limit(3)
    moved = (tel.join(F.broadcast(first), (F.col("obs_ts") == F.col("_at")) & (F.col("joint_name") == "joint_1"), "left")
             .withColumn("obs_ts", F.when(F.col("_at").isNotNull(), seed_ts).otherwise(F.col("obs_ts"))).drop("_at"))
    return joint_position(spark, GB.TelemetryGraph(spark, moved, dedup=False), "joint_1")


# --- O3 / O5: first 1000 readings by time (the top-N is the report's feature) -------------
@report("humidity_series", sql=graph_sql("""
SELECT es.hasTimestamp AS timestamp, es.hasHumidity AS Humidity
FROM es JOIN hrd ON hrd.es_timestamp = es.hasTimestamp
ORDER BY timestamp LIMIT 1000""", ES_SQL, HRD_SQL))
def humidity_series(spark, tg):
    return (_es_edges(spark, tg)
            .select(F.col("es_timestamp").alias("timestamp"), F.col("hasHumidity").alias("Humidity"))
            .orderBy(F.col("timestamp").asc_nulls_last()).limit(1000))


@report("air_quality_series", sql=graph_sql("""
SELECT es.hasTimestamp AS timestamp,
       CASE es.hasAirQuality WHEN 'Good' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'Unhealthy' THEN 3
            ELSE 0 END AS AirQualityLevel
FROM es JOIN hrd ON hrd.es_timestamp = es.hasTimestamp
ORDER BY timestamp LIMIT 1000""", ES_SQL, HRD_SQL))
def air_quality_series(spark, tg):
    return (_es_edges(spark, tg)
            .select(F.col("es_timestamp").alias("timestamp"),
                    air_quality_level("hasAirQuality").alias("AirQualityLevel"))
            .orderBy(F.col("timestamp").asc_nulls_last()).limit(1000))


# --- A9: whole-label counts --------------------------------------------------------------
@report("count_notifications", sql=graph_sql("SELECT count(*) AS count FROM ln", LN_SQL))
def count_notifications(spark, tg):
    return tg.log_notification.agg(F.count("*").alias("count"))


@report("count_environment", sql=graph_sql("SELECT count(*) AS count FROM es", ES_SQL))
def count_environment(spark, tg):
    return tg.environment_sensor.agg(F.count("*").alias("count"))


@report("count_sensors", sql=graph_sql("SELECT count(*) AS count FROM sensor", SENSOR_SQL))
def count_sensors(spark, tg):
    return tg.sensor.agg(F.count("*").alias("count"))


@report("count_error_logs", sql=graph_sql(
    "SELECT count(*) AS count FROM ln WHERE name = 'error'", LN_SQL))
def count_error_logs(spark, tg):
    return tg.log_notification.filter(F.col("name") == "error").agg(F.count("*").alias("count"))
