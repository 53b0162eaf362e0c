"""Streaming queries: the telemetry is published as message files, streamed with
``availableNow`` into sinks under the shared checkpoint folder, and the sink
is read back as the result.

Message files are written in time-ordered appends: equal spans between the first
and the last event time, events without a time in the last one.  Each append has
as many files as the input's size asks for, and a micro-batch takes one whole append.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import parse as P
from ..session import scratch_path
from ..sinks.topic import publish, publish_records
from ..streaming import jobs as J
from ..streaming.graph_store import GraphStore
from .proxy import mapped, records, telemetry, with_telemetry
from .registry import register
from .reports import WS_SQL

APPENDS = 3
FILE_ROWS = 10_000


def segment_sql(n: int) -> str:
    """The append, from 0, of an event in DuckDB; the same rule as ``_segments``."""
    return (f"coalesce(({n} * (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events))) // "
            f"(SELECT max(epoch_us(ts)) - min(epoch_us(ts)) + 1 FROM events), {n - 1})")


def _segments(df: DataFrame, n: int, ts: str = "ts") -> tuple[list[DataFrame], int]:
    """``df`` in ``n`` spans of time, and the files that each of them takes."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    lo, hi, rows = df.agg(F.min(us), F.max(us), F.count("*")).first()
    at = F.lit(n - 1) if lo is None else F.coalesce(F.expr(f"{n}L") * (us - F.lit(lo)), F.lit(None).cast("long"))
    if lo is not None:
        at = F.coalesce(F.floor(at / F.lit(hi - lo + 1)).cast("int"), F.lit(n - 1))
    return [df.filter(at == k) for k in range(n)], rows // (n * FILE_ROWS) + 1


def write_topic(spark, sf_dir, path, encoder=P.encode_v2, tel: DataFrame | None = None, only: slice = slice(None)) -> int:
    """Publish the telemetry in time-ordered appends; returns the files of each append."""
    parts, files = _segments(records(spark, sf_dir) if tel is None else tel, APPENDS)
    for part in parts[only]:
        part = part.repartition(files)  # dealt as narrow rows, before the mapping and the encoding, which are the costly parts
        publish(encoder(mapped(part) if tel is None else part), path)
    return files


def _messages(spark, path, files: int):
    return J.message_stream(spark, "parquet", path, options={"maxFilesPerTrigger": str(files)})


def write_staging(spark, sf_dir, path, appends: int = APPENDS, only=None) -> int:
    """Staging rows (the ingest job's output) written as time-ordered appends."""
    parts, files = _segments(records(spark, sf_dir), appends)
    for k in (only if only is not None else range(appends)):
        P.ingest_v2(P.encode_v2(mapped(parts[k].repartition(files)))).write.mode("append").parquet(path)
    return files


def _staged(spark, path, files: int):
    return J.staging_stream(spark, path, max_files=files)


R6 = 6


# --- S1 / P* / K1 / T6: ingest with both sinks, staging read back --------------------------------
STAGE_SQL = with_telemetry("""
SELECT event_id, ts AS timestamp, joint_name, log_type, round(joint_angle, 6) AS joint_angle,
       round(force_x, 6) AS force_x, environment_humidity FROM telemetry""")


def _staging_out(df):
    return df.select("event_id", J.ntz("timestamp"), "joint_name", "log_type",
                     F.round("joint_angle", R6).alias("joint_angle"), F.round("force_x", R6).alias("force_x"),
                     "environment_humidity")


@register("stream_ingest_flatten", sql=STAGE_SQL)
def stream_ingest_flatten(spark, sf_dir):
    root = scratch_path(spark, "ingest")
    files = write_topic(spark, sf_dir, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    J.run_ingest(spark, _messages(spark, f"{root}/topic", files), f"{root}/staging", store, f"{root}/ckpt")
    return _staging_out(spark.read.parquet(f"{root}/staging"))


# --- K2 / T8: flat sensor stream -> Parquet sink (processing-time trigger in production) ----------
@register("stream_flat_sensor_sink", sql=with_telemetry("""
SELECT event_id, sensor_name AS sensor, round(position_x, 6) AS position_x,
       round(environment_temperature, 6) AS temperature, ts AS timestamp FROM telemetry"""))
def stream_flat_sensor_sink(spark, sf_dir, trigger: dict | None = None):
    root = scratch_path(spark, "flat")
    files = write_topic(spark, sf_dir, f"{root}/topic", encoder=P.encode_flat)
    parsed = P.parse_flat(_messages(spark, f"{root}/topic", files))
    q = J.start_parquet_sink(parsed, f"{root}/out", f"{root}/ckpt", trigger)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.select("event_id", "sensor", F.round("position_x", R6).alias("position_x"),
                      F.round("temperature", R6).alias("temperature"), J.ntz("timestamp"))


# --- K7: streaming append of rows as labelled nodes -------------------------------------------------
@register("stream_append_label_nodes", sql=with_telemetry("""
SELECT 'sensor' AS label, sensor_name AS sensor, ts AS timestamp,
       round(environment_temperature, 6) AS temperature FROM telemetry"""))
def stream_append_label_nodes(spark, sf_dir):
    root = scratch_path(spark, "labelnodes")
    files = write_topic(spark, sf_dir, f"{root}/topic", encoder=P.encode_flat)
    parsed = P.parse_flat(_messages(spark, f"{root}/topic", files)).select("sensor", "timestamp", "temperature")

    # the file sink commits each batch once: a retried batch adds nothing
    labelled = parsed.withColumn("label", F.lit("sensor"))
    J.start_staging_sink(labelled, f"{root}/nodes", f"{root}/ckpt", partition_cols=["label"]).awaitTermination()
    out = spark.read.parquet(f"{root}/nodes")
    return out.select("label", "sensor", J.ntz("timestamp"), F.round("temperature", R6).alias("temperature"))


# --- K3 / M14 / M3-M8: composed per-batch graph upsert ------------------------------------------------
GRAPH_KEYS_SQL = with_telemetry("""
SELECT 'log_notification' AS tbl, log_type AS name, obs_ts AS timestamp FROM d
UNION ALL SELECT 'has_record', log_type, obs_ts FROM d
UNION ALL SELECT 'sensor', '', obs_ts FROM d
UNION ALL SELECT 'has_sensor', joint_name, obs_ts FROM d
UNION ALL SELECT 'environment_sensor', environment_air_quality, obs_ts FROM d
UNION ALL SELECT 'has_reading', 'Environment', obs_ts FROM d""", """d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY obs_ts ORDER BY event_id) AS rn
                 FROM telemetry) x WHERE rn = 1)""")


def _graph_keys(store: GraphStore) -> DataFrame:
    return store.keys_view().select("tbl", "name", J.ntz("timestamp"))


def _graph_run(spark, sf_dir, replay: bool = False, tel: DataFrame | None = None):
    root = scratch_path(spark, "graph")
    topic = f"{root}/topic"
    files = write_topic(spark, sf_dir, topic, tel=tel)
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    J.run_ingest(spark, _messages(spark, topic, files), f"{root}/staging", store, f"{root}/ckpt")
    if replay:
        write_topic(spark, sf_dir, topic)  # the producer re-sends every event
        J.run_ingest(spark, _messages(spark, topic, files), f"{root}/staging", store, f"{root}/ckpt")
        # and a consumer with a new checkpoint reads the whole topic again, over the filled store
        J.run_ingest(spark, _messages(spark, topic, files), f"{root}/staging2", store, f"{root}/ckpt2")
    return store


@register("stream_graph_upsert", headline=True, sql=GRAPH_KEYS_SQL)
def stream_graph_upsert(spark, sf_dir):
    return _graph_keys(_graph_run(spark, sf_dir))


@register("stream_replay_idempotent", sql=GRAPH_KEYS_SQL)
def stream_replay_idempotent(spark, sf_dir):
    """Every event sent twice (second copy in later batches): the graph is unchanged."""
    return _graph_keys(_graph_run(spark, sf_dir, replay=True))


@register("batch_metrics", sql=with_telemetry(f"""
SELECT {segment_sql(APPENDS)} AS batch_id, count(*) AS records, true AS timed, true AS per_record
FROM telemetry GROUP BY 1"""))
def batch_metrics(spark, sf_dir):
    """One row per micro-batch (an append each); its times are checked, not compared."""
    root = scratch_path(spark, "metrics")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    for k in range(APPENDS):
        files = write_topic(spark, sf_dir, f"{root}/topic", only=slice(k, k + 1))
        J.run_ingest(spark, _messages(spark, f"{root}/topic", files), f"{root}/staging", store, f"{root}/ckpt")
    return store.read("metrics").select(
        F.col("batch_id").cast("long").alias("batch_id"), "records", (F.col("seconds") > 0).alias("timed"),
        F.col("seconds_per_record").isNotNull().alias("per_record"))


@register("stream_rejects", sql=with_telemetry("SELECT event_id, joint_name FROM telemetry WHERE event_id % 50 = 0"))
def stream_rejects(spark, sf_dir):
    """Events without a time reach the rejects table; they key no node."""
    tel = telemetry(spark, sf_dir)
    lost = F.when(F.col("event_id") % 50 != 0, F.col("ts"))
    store = _graph_run(spark, sf_dir, tel=tel.withColumn("ts", lost).withColumn("obs_ts", lost))
    return store.read("rejects").select("event_id", "joint_name")


# --- T4: restart from the checkpoint: each event staged exactly once ---------------------------------
@register("stream_restart_exactly_once", sql=with_telemetry(
    "SELECT event_id, ts AS timestamp, joint_name, log_type FROM telemetry"))
def stream_restart_exactly_once(spark, sf_dir):
    root = scratch_path(spark, "restart")
    topic, staging, ckpt = f"{root}/topic", f"{root}/staging", f"{root}/ckpt"
    for only in (slice(0, 1), slice(1, None)):  # run, stop, more data arrives, restart
        files = write_topic(spark, sf_dir, topic, only=only)
        q = J.start_staging_sink(J.parsed_stream(_messages(spark, topic, files)), staging, ckpt)
        q.awaitTermination()
    out = spark.read.parquet(staging)
    return out.select("event_id", J.ntz("timestamp"), "joint_name", "log_type")


# --- S3 / T1 / T2: watermarked window aggregates, append mode ---------------------------------------------
def _closed(extra_where: str = "") -> str:
    return (f"ws + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events {extra_where}) - INTERVAL 5 MINUTE")


def _win_counts_sql(where: str = "") -> str:
    return with_telemetry(f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, log_type, count(log_type) AS log_count
FROM (SELECT {WS_SQL} AS ws, log_type FROM telemetry {where}) t
WHERE {_closed(where)}
GROUP BY ws, log_type""")


def _win_out(df):
    return df.select(J.ntz("window_start"), J.ntz("window_end"), "log_type", "log_count")


@register("stream_window_log_counts", sql=_win_counts_sql())
def stream_window_log_counts(spark, sf_dir):
    root = scratch_path(spark, "winlog")
    files = write_staging(spark, sf_dir, f"{root}/staging")
    agg = J.window_log_counts_stream(_staged(spark, f"{root}/staging", files))
    J.start_parquet_sink(agg, f"{root}/out", f"{root}/ckpt").awaitTermination()
    return _win_out(spark.read.parquet(f"{root}/out"))


@register("stream_window_humidity", sql=with_telemetry(f"""
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end,
       round(avg(TRY_CAST(environment_humidity AS DOUBLE)), 6) AS avg_humidity
FROM (SELECT {WS_SQL} AS ws, environment_humidity FROM telemetry) t
WHERE {_closed()}
GROUP BY ws"""))
def stream_window_humidity(spark, sf_dir):
    root = scratch_path(spark, "winhum")
    files = write_staging(spark, sf_dir, f"{root}/staging")
    agg = J.window_humidity_stream(_staged(spark, f"{root}/staging", files))
    J.start_parquet_sink(agg, f"{root}/out", f"{root}/ckpt").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.select(J.ntz("window_start"), J.ntz("window_end"),
                      F.round("avg_humidity", R6).alias("avg_humidity"))


# --- T3: rows older than the watermark are dropped -------------------------------------------------------
@register("stream_late_rows", sql=_win_counts_sql(f"WHERE {segment_sql(2)} = 1"))
def stream_late_rows(spark, sf_dir):
    """Run 1 sees the later half of the time; run 2 (restarted from the checkpoint) receives the
    earlier half, all older than the restored watermark - every one of them is dropped."""
    root = scratch_path(spark, "late")
    staging, out, ckpt = f"{root}/staging", f"{root}/out", f"{root}/ckpt"
    for only in ([1], [0]):
        files = write_staging(spark, sf_dir, staging, appends=2, only=only)
        agg = J.window_log_counts_stream(_staged(spark, staging, files))
        J.start_parquet_sink(agg, out, ckpt).awaitTermination()
    return _win_out(spark.read.parquet(out))


# --- T7: ingest -> staging folder -> aggregator (chained jobs) -------------------------------------------
@register("stream_pipeline_e2e", sql=_win_counts_sql())
def stream_pipeline_e2e(spark, sf_dir):
    root = scratch_path(spark, "e2e")
    files = write_topic(spark, sf_dir, f"{root}/topic")
    q = J.start_staging_sink(J.parsed_stream(_messages(spark, f"{root}/topic", files)),
                             f"{root}/staging", f"{root}/ckpt_ingest")
    q.awaitTermination()
    agg = J.window_log_counts_stream(_staged(spark, f"{root}/staging", files))
    J.start_parquet_sink(agg, f"{root}/out", f"{root}/ckpt_agg").awaitTermination()
    return _win_out(spark.read.parquet(f"{root}/out"))


# --- K5 / M9 / M10: summaries upserted from emitted windows --------------------------------------------------
@register("stream_summary_upsert", sql=with_telemetry(f"""
SELECT 'log' AS kind, log_type AS logType, arg_max(n, ws) AS count, CAST(NULL AS DOUBLE) AS avg_humidity,
       max(ws) AS timestamp, 'Log' AS src, 'HAS_LOG_SUMMARY' AS edge
FROM (SELECT ws, log_type, count(log_type) AS n FROM (SELECT {WS_SQL} AS ws, log_type FROM telemetry) t
      WHERE {_closed()} GROUP BY 1, 2) w WHERE log_type IS NOT NULL GROUP BY log_type
UNION ALL
SELECT 'env', NULL, NULL, round(arg_max(h, ws), 6), max(ws), 'Environment', 'HAS_ENV_SUMMARY'
FROM (SELECT ws, avg(TRY_CAST(environment_humidity AS DOUBLE)) AS h
      FROM (SELECT {WS_SQL} AS ws, environment_humidity FROM telemetry) t WHERE {_closed()} GROUP BY 1) w"""))
def stream_summary_upsert(spark, sf_dir):
    root = scratch_path(spark, "summary")
    files = write_staging(spark, sf_dir, f"{root}/staging")
    staged = _staged(spark, f"{root}/staging", files)
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    qs = J.start_summary_sink(J.window_log_counts_stream(staged), J.window_humidity_stream(staged), store, f"{root}/ckpt")
    J.await_all(qs)
    log_latest, env_latest = J.summary_tables(store)
    a = log_latest.select(F.lit("log").alias("kind"), "logType", "count", F.lit(None).cast("double").alias("avg_humidity"),
                          J.ntz("timestamp"), "src", "edge")
    b = env_latest.select(F.lit("env").alias("kind"), F.lit(None).cast("string").alias("logType"),
                          F.lit(None).cast("bigint").alias("count"), F.round("avg_humidity", R6).alias("avg_humidity"),
                          J.ntz("timestamp"), "src", "edge")
    return a.unionByName(b)


# --- S1 / S2: records in the order of their topic positions ------------------------------------------------
PARTITIONS = 3
POSITIONS_SQL = with_telemetry("""
SELECT 'log_notification' AS tbl, log_type AS name, obs_ts AS timestamp FROM d
UNION ALL SELECT 'has_sensor', joint_name, obs_ts FROM d""", f"""pos AS (
  SELECT *, event_id % {PARTITIONS} AS part,
         row_number() OVER (PARTITION BY event_id % {PARTITIONS} ORDER BY app, ts, event_id) - 1 AS off
  FROM (SELECT *, {segment_sql(2)} AS app FROM telemetry) x)""", """d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY obs_ts ORDER BY part, off) AS rn FROM pos) y WHERE rn = 1)""")


def write_partitioned_topic(spark, sf_dir, path) -> None:
    """The telemetry in two appends to a topic of three partitions; the second goes on at the offsets of the first."""
    def encoded(placed: DataFrame) -> DataFrame:
        at = ("key", "partition", "offset")
        return P.encode_v2(mapped(placed, keep=at), key_cols=at)

    parts, _ = _segments(records(spark, sf_dir), 2)
    for part in parts:
        rows = part.withColumn("key", F.col("event_id").cast("string")).withColumn("partition", (F.col("event_id") % PARTITIONS).cast("int"))
        publish_records(rows, path, ["ts", "event_id"], encode=encoded)


def _survivors(store: GraphStore) -> DataFrame:
    return _graph_keys(store).filter(F.col("tbl").isin("log_notification", "has_sensor"))


@register("stream_topic_positions", sql=POSITIONS_SQL)
def stream_topic_positions(spark, sf_dir):
    """Of the records of one instant the one at the lowest (partition, offset) is kept."""
    root = scratch_path(spark, "positions")
    write_partitioned_topic(spark, sf_dir, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    records = J.message_stream(spark, "parquet", f"{root}/topic", schema=J.TOPIC_SCHEMA)
    J.run_ingest(spark, records, f"{root}/staging", store, f"{root}/ckpt", keep=J.KAFKA_KEEP, order=list(J.KAFKA_KEEP))
    return _survivors(store)


@register("batch_topic_positions", sql=POSITIONS_SQL)
def batch_topic_positions(spark, sf_dir):
    """A bounded read of the topic from its earliest offset, then one from where that ended (nothing is left)."""
    root = scratch_path(spark, "positions")
    write_partitioned_topic(spark, sf_dir, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    starting: str | dict[int, int] = "earliest"
    for batch in range(2):
        records = J.from_offsets(J.message_batch(spark, "parquet", f"{root}/topic", schema=J.TOPIC_SCHEMA), starting)
        parsed = P.ingest_v2(records, keep=J.KAFKA_KEEP).withColumn("obs_ts", F.col("timestamp"))
        store.upsert_batch(parsed, batch, order=list(J.KAFKA_KEEP))
        ended = records.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()
        starting = {r["partition"]: r["next"] for r in ended}
    return _survivors(store)


# --- T6: two live queries of one parsed stream ---------------------------------------------------------------
@register("stream_two_live_queries", sql=GRAPH_KEYS_SQL + " UNION ALL SELECT 'staging', joint_name, ts FROM telemetry")
def stream_two_live_queries(spark, sf_dir):
    """The staging sink and the graph sink, both live at once on one parsed stream, each with its own checkpoint."""
    root = scratch_path(spark, "live")
    files = write_topic(spark, sf_dir, f"{root}/topic")
    store = GraphStore(spark, f"{root}/graph")
    store.seed()
    J.await_any(J.run_live(_messages(spark, f"{root}/topic", files), f"{root}/staging", store, f"{root}/ckpt"))
    staged = spark.read.parquet(f"{root}/staging")
    return _graph_keys(store).unionByName(staged.select(F.lit("staging").alias("tbl"), F.col("joint_name").alias("name"), J.ntz("timestamp")))


# --- T5: copies within and beyond the watermark, over restarts --------------------------------------------------
def _later_sql() -> str:
    return "(SELECT (2 * (max(epoch_us(ts)) - min(epoch_us(ts)))) // 3 + 1000000 FROM events)"


@register("stream_dedup_watermark", sql=with_telemetry(f"""
SELECT event_id, ts AS timestamp FROM telemetry
UNION ALL SELECT event_id, ts + to_microseconds({_later_sql()}) FROM telemetry WHERE {segment_sql(APPENDS)} = 0"""))
def stream_dedup_watermark(spark, sf_dir):
    """Re-sent records against state that the watermark bounds, over two restarts of one checkpoint.

    Run 1: the first third, each record twice (one stays).  Run 2: the second third, and all of the first again
    (copies near the watermark meet their state, older ones are late: none stays).  Run 3: the last third, and the
    first once more with new event times: their state has expired by then, so they are records of their own.
    """
    root = scratch_path(spark, "dedup")
    rows = records(spark, sf_dir)
    parts, files = _segments(rows, APPENDS)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = rows.agg(F.min(us), F.max(us)).first()
    later = (2 * ((hi or 0) - (lo or 0))) // 3 + 1_000_000
    moved = parts[0].withColumn("ts", F.timestamp_micros(us + F.lit(later)).cast("timestamp_ntz"))
    for again, part in zip((parts[0], parts[0], moved), parts, strict=True):
        publish(P.encode_v2(mapped(part.unionByName(again).repartition(files))), f"{root}/topic")
        # all files of a run are one micro-batch: within a run nothing is late
        stream = J.message_stream(spark, "parquet", f"{root}/topic")
        J.start_staging_sink(J.parsed_stream(stream), f"{root}/staging", f"{root}/ckpt", dedup_keys=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{root}/staging").select("event_id", J.ntz("timestamp"))


# --- T3: late rows are kept ------------------------------------------------------------------------------------
LATE_SQL = with_telemetry("""
SELECT CAST(CASE app WHEN 0 THEN 1 ELSE 2 END AS BIGINT) AS batch_id, event_id, ts AS timestamp FROM s
WHERE app = 0 AND (epoch_ms(ts) // 300000 + 1) * 300000 <= (SELECT max(epoch_ms(ts)) FROM s WHERE app = 1) - 300000
   OR app = 2 AND (epoch_ms(ts) // 300000 + 1) * 300000 <= (SELECT max(epoch_ms(ts)) FROM s WHERE app < 2) - 300000
""", f"s AS (SELECT *, {segment_sql(APPENDS)} AS app FROM telemetry)")


@register("stream_late_table", sql=LATE_SQL)
def stream_late_table(spark, sf_dir):
    """The middle third arrives first, then the first third (late, but for the newest windows), then the last: the
    late rows by batch, from the table that is kept beside the windowed aggregates."""
    root = scratch_path(spark, "latetable")
    late = J.LateRows(spark, f"{root}/late")
    for only in ([1], [0], [2]):
        write_staging(spark, sf_dir, f"{root}/staging", only=only)
        staged = J.staging_stream(spark, f"{root}/staging", schema=T.StructType([T.StructField("event_id", T.LongType()), *S.STAGING.fields]))
        late.start(staged, f"{root}/ckpt").awaitTermination()
    return late.rows().select(F.col("batch_id").cast("long").alias("batch_id"), "event_id", J.ntz("timestamp"))
