"""Structured Streaming jobs: ingest (staging, and the graph from staging) and the
windowed aggregator reading the ingest job's staging output.

Sources are injectable: ``format="kafka"`` with broker options in production,
a Parquet folder of message files in tests (same ``value`` binary column).
Every query has its own checkpoint location under the shared checkpoint
folder; restarting a query from it resumes exactly where it stopped.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import parse as P
from ..operators import windows as W
from ..operators import graph as G
from .graph_store import GraphStore

#: A topic's records as files: key, value and the record's position, as a broker gives them.
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("value", T.BinaryType()),
])


# --- S1 / S3: sources -------------------------------------------------------------------
def message_stream(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                   options: dict | None = None, schema: T.StructType | None = MESSAGE_FILE_SCHEMA) -> DataFrame:
    """Unbounded stream of binary messages (``value``).  For Kafka pass
    ``fmt="kafka"`` and ``options={"kafka.bootstrap.servers": ..., "subscribe": topic}``;
    the tie-break column is then the (partition, offset) of each record."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka" and schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def message_batch(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                  options: dict | None = None, schema: T.StructType | None = MESSAGE_FILE_SCHEMA) -> DataFrame:
    """Bounded read of everything a topic holds.  For Kafka pass ``fmt="kafka"``
    (``startingOffsets`` defaults to earliest here); a message folder otherwise."""
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
    r = spark.read.format(fmt).options(**opts)
    if fmt != "kafka" and schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def from_offsets(records: DataFrame, starting: str | dict[int, int] = "earliest") -> DataFrame:
    """Records of a file topic from the given position on: ``earliest``, or the first offset of each partition
    (partitions that are not named start at the earliest), as ``startingOffsets`` has it for a broker's topic."""
    if starting == "earliest":
        return records
    first = F.lit(0)
    for k, at in starting.items():
        first = F.when(F.col("partition") == k, F.lit(at)).otherwise(first)
    return records.filter(F.col("offset") >= first)


def staging_stream(spark: SparkSession, path: str, schema: T.StructType = S.STAGING,
                   max_files: int | None = None) -> DataFrame:
    """S3: streaming Parquet scan of the staging folder with a declared schema."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def _trigger(w, trigger: dict | None):
    return w.trigger(**(trigger or {"availableNow": True}))


# --- ingest: parse once, the graph reads staging -----------------------------------------------------------
def parsed_stream(messages: DataFrame, keep=("event_id",)) -> DataFrame:
    """Decode + parse + flatten + cast, all built-in expressions (no Python worker)."""
    return P.ingest_v2(messages, keep=keep)


def dedup_within_watermark(parsed: DataFrame, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """T5 option: drop re-sent copies of a record (same ``keys``) that arrive within
    ``delay`` of the newest event time; copies older than the watermark are dropped
    as late.  State is bounded by the watermark, not by the stream's history."""
    return parsed.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(keys)


def start_staging_sink(parsed: DataFrame, out: str, checkpoint: str, trigger: dict | None = None,
                       partition_cols: list[str] | None = None,
                       dedup_keys: list[str] | None = None) -> StreamingQuery:
    """K1 / K2: append-only Parquet sink with its own checkpoint (optionally replay-safe)."""
    if dedup_keys:
        parsed = dedup_within_watermark(parsed, dedup_keys)
    w = (parsed.writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    return _trigger(w, trigger).start()


def start_graph_sink(parsed: DataFrame, store: GraphStore, checkpoint: str,
                     trigger: dict | None = None, order: str | list[str] = "event_id") -> StreamingQuery:
    """K3 / K9: foreachBatch -> dedup + three insert-if-absent writes + metrics row."""
    def process(batch: DataFrame, batch_id: int) -> None:
        staged = batch.withColumn("obs_ts", F.col("timestamp"))
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        m = store.upsert_batch(staged, batch_id, order=order, run_id=run)
        store.write_metrics(m)
    w = parsed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


KAFKA_KEEP = ("partition", "offset")  # a Kafka record's position: the tie-break order


def run_live(messages: DataFrame, staging: str, store: GraphStore, checkpoint_root: str, trigger: dict | None = None,
             keep=("event_id",), order: str | list[str] = "event_id") -> list[StreamingQuery]:
    """T6, as one job has it: two queries of one parsed stream, both live at once, each with its own checkpoint.

    Returns both started queries; ``await_any`` waits for either to end and stops the other if it failed.
    """
    parsed = parsed_stream(messages, keep=keep)
    return [start_staging_sink(parsed, staging, f"{checkpoint_root}/staging", trigger),
            start_graph_sink(parsed, store, f"{checkpoint_root}/graph", trigger, order=order)]


def await_any(queries: list[StreamingQuery]) -> None:
    """Wait until all have ended; the first that fails stops the others, and its error is raised."""
    try:
        while any(q.isActive for q in queries):
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
            queries[0].awaitTermination(1) if queries[0].isActive else time.sleep(0.1)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def run_ingest(spark: SparkSession, messages: DataFrame, staging: str, store: GraphStore,
               checkpoint_root: str, trigger: dict | None = None, keep=("event_id",),
               order: str | list[str] = "event_id") -> None:
    """Parse once, then two queries: staging from the messages, the graph from staging.

    The staging sink commits each file once and the graph query reads only committed
    files.  Returns when both are done (availableNow) or raises as soon as either
    fails.  For Kafka input pass ``keep=KAFKA_KEEP, order=list(KAFKA_KEEP)`` so the first
    record of a key is the lowest offset.
    """
    # Per-batch row counts in the query's progress, without an extra job
    parsed = parsed_stream(messages, keep=keep).observe(
        "ingest", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("timestamp").isNull()).alias("no_timestamp"))
    continuous = bool(trigger) and not (trigger.get("availableNow") or trigger.get("once"))
    if continuous:
        spark.streams.resetTerminated()  # forget queries that ended before this run
    q1 = start_staging_sink(parsed, staging, f"{checkpoint_root}/staging", trigger)
    if continuous:
        while q1.isActive and not q1.recentProgress:  # the folder exists after the first commit
            time.sleep(0.2)
    else:
        q1.awaitTermination()
    staged = staging_stream(spark, staging, schema=parsed.schema)
    q2 = start_graph_sink(staged, store, f"{checkpoint_root}/graph", trigger, order=order)
    if continuous:
        # continuous run: wait for the first query to end (or fail), then stop the other
        try:
            spark.streams.awaitAnyTermination()
        finally:
            for q in (q1, q2):
                if q.isActive:
                    q.stop()
        for q in (q1, q2):
            if q.exception() is not None:
                raise q.exception()
        return
    q2.awaitTermination()


# --- aggregator: watermark + tumbling windows, append mode -----------------------------------
def window_log_counts_stream(staged: DataFrame, delay: str = "5 minutes", width: str = "5 minutes") -> DataFrame:
    """Emitted once the watermark passes the window end."""
    return W.window_log_counts(staged.withWatermark("timestamp", delay), "timestamp", width)


def window_humidity_stream(staged: DataFrame, delay: str = "5 minutes", width: str = "5 minutes") -> DataFrame:
    return W.window_avg_humidity(staged.withWatermark("timestamp", delay), "timestamp", width)


# --- T3: late rows are kept ------------------------------------------------------------------------
class LateRows:
    """Rows that come too late for the windowed aggregates, by batch, beside the aggregates themselves.

    A row is late, as it is for the aggregate, if its window has ended at or before the watermark, which is the
    largest event time of earlier batches less the delay.  Each batch writes its late rows and its largest event
    time into its own partition, so a batch that is run again finds the same watermark and writes the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, delay_s: int = 300, width_s: int = 300):
        self.spark, self.root, self.delay, self.width = spark, root, delay_s, width_s

    def _read(self, name: str) -> DataFrame | None:
        return GraphStore(self.spark, self.root).read(name)

    def watermark_ms(self, batch_id: int) -> int | None:
        """The watermark of a batch, in milliseconds; None before any event."""
        held = self._read("seen")
        top = None if held is None else held.filter(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        return None if top is None else top - self.delay * 1000

    def process(self, batch: DataFrame, batch_id: int) -> None:
        ms = F.unix_millis(F.col("timestamp").cast("timestamp"))
        mark = self.watermark_ms(batch_id)
        ends = (F.floor(ms / (self.width * 1000)) + 1) * (self.width * 1000)
        late = batch.filter(ends <= F.lit(mark)) if mark is not None else batch.limit(0)
        (late.withColumn("watermark", F.timestamp_millis(F.lit(mark).cast("long"))).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").partitionBy("batch_id").parquet(f"{self.root}/late"))
        (batch.agg(F.max(ms).alias("top")).filter("top is not null").withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").partitionBy("batch_id").parquet(f"{self.root}/seen"))

    def start(self, staged: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        w = staged.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return _trigger(w, trigger).start()

    def rows(self) -> DataFrame | None:
        """(all columns of the stream, watermark, batch_id) of every late row."""
        return self._read("late")


def start_parquet_sink(df: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


SUMMARIES = {
    # name: (key columns, value column, anchor label, relationship)
    "log_summary": (["logType"], "count", "Log", "HAS_LOG_SUMMARY"),
    "env_summary": ([], "avg_humidity", "Environment", "HAS_ENV_SUMMARY"),
}


def upsert_summary(store: GraphStore, name: str, rows: DataFrame, batch_id: int) -> None:
    """SET on one node per key: the latest window wins, and only the latest is kept.

    The write starts with MATCH (anchor): without the seeded anchor it writes nothing.
    Two slots take turns, so a reader always finds a whole one; a batch that is run
    again merges the same rows into the same state.
    """
    keys, value, label, edge = SUMMARIES[name]
    seed = store.read("seed_nodes")
    if seed is None or seed.filter((F.col("label") == label) & (F.col("name") == label)).isEmpty():
        return
    rows = rows.select(*keys, value, "timestamp").withColumn("src", F.lit(label)).withColumn("edge", F.lit(edge))
    for slot in (0, 1):
        held = store.read(f"{name}/slot={slot}")
        if held is not None:
            rows = rows.unionByName(held.select(*rows.columns))
    latest = G.last_per_key(rows, keys, ["timestamp"]).select(*rows.columns)
    # at most one row a key; cut from its inputs, as one of them is overwritten now
    latest.checkpoint(eager=True).write.mode("overwrite").parquet(store.path(f"{name}/slot={batch_id % 2}"))


def start_summary_sink(log_counts: DataFrame, humidity: DataFrame, store: GraphStore, checkpoint_root: str,
                       trigger: dict | None = None) -> list[StreamingQuery]:
    """Each emitted window upserts the summaries; the last write wins."""
    def log_rows(batch):
        return batch.filter(F.col("log_type").isNotNull()).select(
            F.col("log_type").alias("logType"), F.col("log_count").alias("count"), F.col("window_start").alias("timestamp"))

    def env_rows(batch):
        return batch.select("avg_humidity", F.col("window_start").alias("timestamp"))

    def start(df, name, rows):
        w = df.writeStream.foreachBatch(lambda batch, n: upsert_summary(store, name, rows(batch), n))
        return _trigger(w.option("checkpointLocation", f"{checkpoint_root}/{name}"), trigger).start()

    return [start(log_counts, "log_summary", log_rows), start(humidity, "env_summary", env_rows)]


def summary_tables(store: GraphStore) -> tuple[DataFrame, DataFrame]:
    """(LogSummary per log type, the single EnvironmentSummary), each with its anchor and relationship."""
    return tuple(G.last_per_key(store.read(name).drop("slot"), keys, ["timestamp"]) for name, (keys, *_) in SUMMARIES.items())


def await_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()


def ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)
