"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # streaming aggregation state lives in RocksDB (off-heap, spills to local disk,
    # checkpointed incrementally) instead of executor heap maps
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # iterative operators checkpoint every round; delete a round's files once its RDD is
    # garbage-collected so the shared folder does not grow with every query
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sensorweave", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized to the data (roughly input bytes /
    128 MB), AQE coalesces the rest at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Settings every plan of this library assumes (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    k = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(k, None)
    if not cur or cur.endswith("HDFSBackedStateStoreProvider"):  # the built-in default
        spark.conf.set(k, DEFAULT_CONF[k])
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present.  Where it is unset a local
    session gets a private folder (one process, one disk); any other master
    raises, as executors would write to their own disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the context
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc is None or not (sc.master or "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="sensorweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sensorweave/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)
