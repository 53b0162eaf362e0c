"""Merge targets bucketed and sorted by key: a merge moves the batch, never the target.

The table's files are dealt by the hash of its key, so the anti-join of an insert-if-absent
merge asks for an exchange of the batch only, whatever the target's size.  New rows are
appended to the same buckets.  ``compact`` writes one sorted file a bucket again, so that the
merge join does not even sort the target.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import graph as G


class BucketedTable:
    """An external table in the session's catalogue; ``drop`` forgets it there and leaves its files."""

    def __init__(self, spark: SparkSession, keys: list[str], buckets: int | None = None, name: str | None = None, path: str | None = None):
        self.spark, self.keys = spark, list(keys)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = name or f"bucketed_{uuid.uuid4().hex}"
        self.path = path or scratch_path(spark, self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        """Rows into the buckets: dealt by the key first, so that a bucket gets one file."""
        rows = rows.repartition(self.buckets, *self.keys)
        w = rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).format("parquet").mode("append")
        (w if self.exists() else w.option("path", self.path)).saveAsTable(self.name)

    def new_rows(self, incoming: DataFrame, order, values=None) -> DataFrame:
        """The first row of each key of ``incoming`` that the table lacks; null keys are no keys."""
        first = G.first_per_key(incoming, self.keys, order, values)
        if not self.exists():
            return first
        return first.join(self.read().select(*self.keys).hint("merge"), self.keys, "left_anti")

    def merge(self, incoming: DataFrame, order, values=None) -> None:
        """MERGE ... ON CREATE SET; merging the same rows again adds nothing."""
        self.append(self.new_rows(incoming, order, values))

    def compact(self) -> BucketedTable:
        """The same rows in a new table with one sorted file for each bucket."""
        out = BucketedTable(self.spark, self.keys, self.buckets)
        out.append(self.read())
        return out

    def counts(self) -> DataFrame:
        """(key..., n) of the rows of each key, without an exchange."""
        return self.read().groupBy(*self.keys).agg(F.count("*").alias("n"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
