"""Batch Parquet scans of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting columns here lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def tables_state(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple:
    """(file, length, modification time) of every file of the tables: what was stored from other states is out of date."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
