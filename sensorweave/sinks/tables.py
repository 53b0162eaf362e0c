"""Batch sinks: node/edge tables as Parquet, labelled node appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_nodes(df: DataFrame, root: str, label: str) -> None:
    """K6: append rows as nodes of ``label`` (no dedup), one folder per label."""
    df.withColumn("label", F.lit(label)).write.mode("append").partitionBy("label").parquet(root)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write a node or edge table; with dynamic partition overwrite a replayed
    batch replaces only its own partitions."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_ordered_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """CSV files in a total order: ranges of ``order`` in files whose names ascend with the ranges, sorted inside."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.option("header", True)
     .option("quote", '"').option("escape", '"').mode("overwrite").csv(path))
