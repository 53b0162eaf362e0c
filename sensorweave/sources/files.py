"""File sources: CSV with header (all text), line-oriented triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column text.  JSON members inside cells
    use doubled quotes, hence quote = escape = '"'."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("quote", '"').option("escape", '"').csv(path))


def read_csv_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ordered CSV files with ``position``, from 1: the row's place over all files by name.

    A row's place is its place in its part of a file, plus the rows of the parts before; no
    sort, and only one row for each part in a window.
    """
    part = F.struct(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("at"))
    rows = (read_csv_strings(spark, path).select("*", part.alias("_part"))
            .withColumn("_row", F.monotonically_increasing_id()))
    parts = rows.groupBy("_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("_part").alias("_p"), "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.join(parts, F.col("_part") == F.col("_p"))
            .withColumn("position", F.col("_row") - F.col("_first") + F.col("_before") + 1)
            .drop("_part", "_row", "_p", "_first", "_before"))
