"""Graph tables on shared storage, maintained by idempotent micro-batch merges.

Each node / edge table is a Parquet folder partitioned by ``event_date`` (for
timestamp-keyed tables), ``run_id`` and ``batch_id``; the run is the streaming
query's id, which lives in its checkpoint.  A batch writes only its own
partitions with dynamic partition overwrite, and its insert-if-absent check looks
at all partitions but its own - so a batch that is re-run after a failure
rewrites exactly the same rows, replayed events add nothing (first write wins
across batches), and a new checkpoint over a filled store starts no new history.

The anti-join against the existing table reads only the key columns, and only the folders
of the event dates that the batch has are listed and opened (a record with a wrong clock adds its
one date, not the days between), inside them the timestamp range (Parquet row-group statistics).
``compact_to`` writes a store with one run and few files for each date.

Deletes are merged on read.  ``delete`` writes the keys that go, as tombstones, beside the
table and beside the edge tables that reference the node; every row carries the store's
epoch, the number of deletes before it, and a tombstone hides the rows of earlier epochs only,
so a key that is merged again later is there again.  A delete has a name; what is
written of it stays when it is run again.  Compaction drops hidden rows and tombstones.
"""

from __future__ import annotations

import time

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import graph as G
from ..plans import graph_build as GB

DATE_COL = "event_date"  # partition column of timestamp-keyed tables

TABLES = {
    # name: (key columns, timestamp column used for range pruning)
    "log_notification": (["name", "timestamp"], "timestamp"),
    "has_record": (["log_name", "ln_name", "ln_timestamp", "timestamp"], "timestamp"),
    "sensor": (["timestamp"], "timestamp"),
    "has_sensor": (["joint_name", "sensor_timestamp"], "sensor_timestamp"),
    "environment_sensor": (["hasTimestamp"], "hasTimestamp"),
    "has_reading": (["env_name", "es_timestamp", "timestamp"], "es_timestamp"),
    # nodes MERGEd by name only (created when neither the seed nor an earlier batch has them)
    "joint": (["name"], None),
    "environment": (["name"], None),
}

#: Edge tables that reference a node table: {edge table: {node key: edge column}}.
DETACH = {
    "log_notification": {"has_record": {"name": "ln_name", "timestamp": "ln_timestamp"}},
    "sensor": {"has_sensor": {"timestamp": "sensor_timestamp"}},
    "environment_sensor": {"has_reading": {"hasTimestamp": "es_timestamp"}},
}
STORE_COLS = ("run_id", "batch_id", DATE_COL, "epoch")


def _absent(e: AnalysisException) -> bool:
    """Whether the error says that there is no table yet."""
    cond = (e.getCondition() if hasattr(e, "getCondition") else e.getErrorClass()) or ""
    return cond in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class GraphStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _parquet(self, path: str, *paths: str) -> DataFrame | None:
        """A table, or None when nothing has been written to it yet.  Any other failure
        (unreadable files, schema conflicts) is raised, never swallowed."""
        try:
            return self.spark.read.option("basePath", path).parquet(*(paths or (path,)))
        except AnalysisException as e:
            if _absent(e):
                return None
            raise

    def read(self, name: str) -> DataFrame | None:
        """The visible rows of a table, or None when there is none yet."""
        df = self._parquet(self.path(name))
        return df if df is None or name not in TABLES else self._visible(name, df)

    # --- deletes: tombstones, merged on read (M13) --------------------------------------
    def tombstones(self, name: str) -> DataFrame | None:
        return self._parquet(f"{self.root}/tombstones/{name}")

    def _visible(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` without those that a later delete hides."""
        dead = self.tombstones(name)
        if dead is None:
            return rows
        keys = [c for c in dead.columns if c not in ("delete_id", "epoch")]
        dead = dead.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("epoch").alias("_epoch"))
        hit = F.col("epoch") < F.col("_epoch")
        for k in keys:
            hit = hit & (F.col(k) == F.col(f"_{k}"))
        return rows.join(dead, hit, "left_anti")

    def epoch(self) -> int:
        """The number of deletes so far, those under way included."""
        return max([0, *self._deletes().values()])

    def _deletes(self) -> dict[str, int]:
        rows = self._parquet(f"{self.root}/deletes")
        return {} if rows is None else {r["delete_id"]: r["epoch"] for r in rows.collect()}  # one small row for each delete

    def delete(self, name: str, victims: DataFrame, delete_id: str) -> None:
        """DETACH DELETE of the nodes with the keys in ``victims``, and of their edges.

        Run again under the same name it goes on where it stopped and changes nothing that is done:
        edges go by the stored victims, whatever ``victims`` holds by then.
        """
        done = self._deletes()
        if delete_id not in done:
            done[delete_id] = max([0, *done.values()]) + 1
            (self.spark.createDataFrame([(delete_id, done[delete_id])], "delete_id string, epoch int")
             .write.mode("append").parquet(f"{self.root}/deletes"))
        epoch, keys = done[delete_id], TABLES[name][0]

        def put(table: str, rows: DataFrame) -> None:
            path = f"{self.root}/tombstones/{table}"
            if self._parquet(path, f"{path}/delete_id={delete_id}") is None:
                rows.distinct().withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{path}/delete_id={delete_id}")

        put(name, victims.select(*keys))
        gone = self._parquet(f"{self.root}/tombstones/{name}/delete_id={delete_id}")
        for edge, columns in DETACH.get(name, {}).items():
            put(edge, gone.select(*[F.col(k).alias(c) for k, c in columns.items()]))

    # --- seed (M1): fixed topology, idempotent ---------------------------------------
    def seed(self, full: bool = False) -> None:
        nodes = GB.seed_nodes(self.spark, full)
        edges = GB.seed_edges(self.spark, full)
        nodes.coalesce(1).write.mode("overwrite").parquet(self.path("seed_nodes"))
        edges.coalesce(1).write.mode("overwrite").parquet(self.path("seed_edges"))

    def anchored(self) -> bool:
        """Whether the Log anchor exists (remembered once found: seeds are never removed)."""
        if not getattr(self, "_anchored", False):
            self._anchored = not self.has_log_anchor().isEmpty()
        return self._anchored

    def has_log_anchor(self) -> DataFrame:
        """The Log node the notification write MATCHes first (empty if not seeded)."""
        seed = self.read("seed_nodes")
        if seed is None:
            return self.spark.createDataFrame([], "log_name string")
        return seed.filter((F.col("label") == "Log") & (F.col("name") == "Log")).select(
            F.col("name").alias("log_name"))

    # --- one insert-if-absent merge -------------------------------------------------------
    def _dated(self, name: str, dates) -> DataFrame | None:
        """The table's folders of the given dates; other dates are not even listed."""
        path = self.path(name)
        return self._parquet(path, f"{path}/{DATE_COL}={{{','.join(sorted(map(str, dates)))}}}")

    def _existing_keys(self, name: str, run_id: str, batch_id: int, lo, hi, dates=None) -> DataFrame | None:
        keys, ts = TABLES[name]
        dated = ts is not None and lo is not None
        cur = self._dated(name, dates) if dated and dates else self._parquet(self.path(name))
        if cur is None:
            return None
        cur = cur.filter(~((F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)))
        return self._visible(name, cur.filter(F.col(ts).between(lo, hi)) if dated else cur).select(*keys)

    def _unseeded(self, label: str, names: DataFrame) -> DataFrame:
        """Names of ``label`` nodes the seed does not already hold (MERGE matches seeded nodes)."""
        seed = self.read("seed_nodes")
        if seed is None:
            return names
        seeded = seed.filter(F.col("label") == label).select("name")
        return names.join(seeded, "name", "left_anti")

    def _write(self, name: str, rows: DataFrame, run_id: str, batch_id: int) -> None:
        ts, parts = TABLES[name][1], ["run_id", "batch_id"]
        if ts is not None:
            # cluster rows by date so each date folder gets few files; AQE still splits
            # an oversized date into several tasks (rebalance, not a plain repartition)
            rows = rows.withColumn(DATE_COL, F.to_date(ts)).hint("rebalance", DATE_COL)
            parts = [DATE_COL, *parts]
        (rows.withColumn("epoch", F.lit(self.epoch())).withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").partitionBy(*parts).parquet(self.path(name)))

    def merge(self, name: str, candidates: DataFrame, batch_id: int, lo=None, hi=None, run_id: str = "batch", dates=None) -> None:
        """Write the candidates whose key is new into the partitions of (``run_id``, ``batch_id``); ``dates``: those they have."""
        existing = self._existing_keys(name, run_id, batch_id, lo, hi, dates)
        new = candidates if existing is None else candidates.join(existing, TABLES[name][0], "left_anti")
        self._write(name, new, run_id, batch_id)

    def compact_to(self, root: str) -> GraphStore:
        """The same graph in a new store: one run, and few files for each date."""
        out = GraphStore(self.spark, root)
        for name in TABLES:
            df = self.read(name)
            if df is not None:
                out._write(name, df.drop(*STORE_COLS), "compacted", 0)
        for name in ("seed_nodes", "seed_edges"):
            df = self.read(name)
            if df is not None:
                df.coalesce(1).write.mode("overwrite").parquet(out.path(name))
        return out

    # --- K3: the composed per-batch upsert of the ingest job ------------------------------------
    def upsert_batch(self, staged: DataFrame, batch_id: int, order: str | list[str] = "event_id",
                     run_id: str = "batch") -> dict:
        """Dedup on timestamp, then the three graph writes of the ingest job.

        ``staged`` are flattened telemetry rows with ``obs_ts`` (the event
        timestamp) and ``order`` (tie-break, e.g. topic offset).  Rows with a
        null key go to ``rejects`` instead of failing the batch.
        """
        t0 = time.time()
        # batch size (before dedup), null keys, and the dates and range for pruning: counted while the batch is
        # deduplicated, in no pass of their own
        seen = Observation("batch")
        staged = staged.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(GB.TS).isNull()).alias("bad"),
                                F.min(GB.TS).alias("lo"), F.max(GB.TS).alias("hi"), F.collect_set(F.to_date(GB.TS)).alias("dates"))
        dedup = G.first_per_key(staged, [GB.TS], order).persist()
        try:
            dedup.count()
            st = seen.get
            n, lo, hi, dates = st["n"], st["lo"], st["hi"], st["dates"]
            if st["bad"]:
                (G.rejects(staged, [GB.TS]).withColumn("run_id", F.lit(run_id)).withColumn("batch_id", F.lit(batch_id)).write
                 .mode("overwrite").partitionBy("run_id", "batch_id").parquet(self.path("rejects")))
            writes = []
            # write 1 starts with MATCH (log:Log): without the seeded anchor it writes nothing
            if self.anchored():
                writes += [
                    ("log_notification", G.first_per_key(GB.log_notification_rows(dedup, order),
                                                         ["name", "timestamp"], order, ["hasMessage"])),
                    ("has_record", GB.merge_has_record(dedup))]
            # write 2: sensor + joint link; write 3: environment reading
            writes += [
                ("sensor", G.first_per_key(GB.sensor_rows(dedup, order=order), ["timestamp"], order,
                                           list(GB.SENSOR_PROPS))),
                ("has_sensor", GB.merge_joint_has_sensor(dedup)),
                ("environment_sensor", G.first_per_key(GB.environment_rows(dedup, order), ["hasTimestamp"],
                                                       order, list(GB.ENV_PROPS))),
                ("has_reading", GB.merge_has_reading(dedup)),
                ("joint", self._unseeded("Joint", dedup.select(F.col("joint_name").alias("name"))
                                         .filter(F.col("name").isNotNull()).distinct())),
                ("environment", self._unseeded("Environment", dedup.limit(1).select(
                    F.lit("Environment").alias("name"))))]
            # the merges touch different tables: submit them as concurrent jobs
            self._concurrently([(name, cand, batch_id, lo, hi, run_id, dates) for name, cand in writes])
        finally:
            dedup.unpersist()
        secs = time.time() - t0
        return {"run_id": run_id, "batch_id": batch_id, "seconds": secs, "records": n,
                "seconds_per_record": (secs / n) if n > 0 else None}

    def write_metrics(self, m: dict) -> None:
        """K9: one metrics row per batch (re-running a batch replaces its row)."""
        df = self.spark.createDataFrame(
            [(m["run_id"], m["batch_id"], float(m["seconds"]), int(m["records"]), m["seconds_per_record"])],
            "run_id string, batch_id long, seconds double, records long, seconds_per_record double")
        df.write.mode("overwrite").partitionBy("run_id", "batch_id").parquet(self.path("metrics"))

    def _concurrently(self, merges: list[tuple]) -> None:
        """Merge several tables at once; threads inherit the job group and local properties."""
        failed = []

        def one(args):
            try:
                self.merge(*args)
            except Exception as e:  # noqa: BLE001 - raised below, in the batch's own thread
                failed.append(e)

        threads = [InheritableThread(target=one, args=(m,)) for m in merges]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failed:
            raise failed[0]

    # --- read back ----------------------------------------------------------------------
    def keys_view(self) -> DataFrame:
        """All graph rows as (tbl, name, timestamp) - one comparable frame."""
        parts = []
        spec = {
            "log_notification": ("name", "timestamp"),
            "has_record": ("ln_name", "ln_timestamp"),
            "sensor": (None, "timestamp"),
            "has_sensor": ("joint_name", "sensor_timestamp"),
            "environment_sensor": ("hasAirQuality", "hasTimestamp"),
            "has_reading": ("env_name", "es_timestamp"),
        }
        for name, (n, ts) in spec.items():
            df = self.read(name)
            if df is None:
                continue
            parts.append(df.select(F.lit(name).alias("tbl"),
                                   (F.col(n) if n else F.lit("")).alias("name"),
                                   F.col(ts).alias("timestamp")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


class StoredGraph:
    """The tables of a ``GraphStore`` with the shape ``TelemetryGraph`` exposes, so the
    graph reports (``plans.reports.REPORTS``) run over the accumulated graph the ingest
    job maintains.  Timestamps are read back as NTZ like the batch view's."""

    def __init__(self, store: GraphStore):
        self.store = store

    def _table(self, name: str) -> DataFrame:
        df = self.store.read(name)
        if df is None:
            raise ValueError(f"graph table {name} has not been written yet")
        return df.select([F.col(f.name).cast("timestamp_ntz").alias(f.name)
                          if f.dataType.typeName() == "timestamp" else F.col(f.name)
                          for f in df.schema.fields if f.name not in STORE_COLS])

    log_notification = property(lambda self: self._table("log_notification"))
    has_record = property(lambda self: self._table("has_record"))
    sensor = property(lambda self: self._table("sensor"))
    has_sensor = property(lambda self: self._table("has_sensor"))
    environment_sensor = property(lambda self: self._table("environment_sensor"))
    has_reading = property(lambda self: self._table("has_reading"))

    def _seed(self, name: str) -> DataFrame:
        df = self.store.read(name)
        if df is None:
            raise ValueError("the graph has not been seeded")
        return df

    seed_nodes = property(lambda self: self._seed("seed_nodes"))
    seed_edges = property(lambda self: self._seed("seed_edges"))
