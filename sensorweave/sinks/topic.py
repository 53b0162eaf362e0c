"""K8: publish rows as JSON messages to a topic (Kafka) or a message folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.ranking import numbered


def publish(messages: DataFrame, path: str | None = None, fmt: str = "parquet",
            options: dict | None = None, files: int | None = None, cluster_by: str | None = None) -> None:
    """Append ``messages`` (a binary ``value`` column plus optional key columns).

    For Kafka: ``fmt="kafka"``, ``options={"kafka.bootstrap.servers": ..., "topic": ...}``.
    For a message folder: each call appends new files, so a file stream sees
    every call as new input; ``cluster_by`` keeps all rows of one key in one file.
    """
    if files:
        messages = (messages.repartition(files, cluster_by) if cluster_by
                    else messages.repartition(files))
    w = messages.write.format(fmt).mode("append").options(**(options or {}))
    if path and fmt != "kafka":
        w.save(path)
    else:
        w.save()


def next_offsets(spark: SparkSession, path: str) -> dict[int, int]:
    """The first free offset of each partition of a file topic; empty before its first record."""
    try:
        held = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}
    return {r["partition"]: r["next"] for r in held.groupBy("partition").agg((F.max("offset") + 1).alias("next")).collect()}


def publish_records(records: DataFrame, path: str, order: list[str], encode: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append ``records`` (key, value, partition and ``order``) to a file topic with the next offsets of their partitions.

    ``encode`` makes ``value`` once the records have their ``offset``, so that numbering moves, samples and stores the
    rows without it.

    Offsets follow ``order`` within a partition; a partition that is too large for one task is numbered by range.
    One writer at a time, as a partition's log has one leader.
    """
    begin = next_offsets(records.sparkSession, path)
    first = F.lit(0).cast("long")
    for k, at in begin.items():
        first = F.when(F.col("partition") == k, F.lit(at).cast("long")).otherwise(first)
    placed = numbered(records, ["partition"], order).withColumn("offset", F.col("rank") - 1 + first)
    if encode is not None:
        placed = encode(placed)
    placed.select("key", "value", "partition", "offset").write.mode("append").parquet(path)
