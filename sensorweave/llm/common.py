"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Rows of an Arrow batch between the JVM and Python: texts may be long, so batches stay small.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small (bounded Python memory)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: later passes agree on one set of rows, and an executor lost
    later costs no recomputation of earlier stages.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, inputs: list, schema: str,
                fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Arrow batches of the given input expressions through ``fn``; texts as UTF-8 bytes."""
    bounded_batches(df.sparkSession)
    return df.select(*inputs).mapInArrow(fn, schema)


def append_columns(df: DataFrame, inputs: dict, fields: str,
                   fn: Callable[..., list]) -> DataFrame:
    """All columns of ``df`` plus the ``fields`` that ``fn(*input lists)`` returns for each batch.

    ``inputs``: name -> expression, handed over under private names, so that extra
    columns of ``df`` with any names pass through untouched.
    """
    bounded_batches(df.sparkSession)
    added = T.StructType.fromDDL(fields)
    n, k = len(df.columns), len(inputs)
    work = df.select(*[F.col(f"`{c}`") for c in df.columns],
                     *[e.alias(f"__in{i}") for i, e in enumerate(inputs.values())])
    out = T.StructType([*df.schema.fields, *added.fields])
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    names = [f.name for f in out.fields]

    def run(batches):
        for b in batches:
            cols = fn(*[b.column(n + i).to_pylist() for i in range(k)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], *[pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)]], names)

    return work.mapInArrow(run, out)


def bitmap(df: DataFrame, key: str, most_bits: int = 26) -> tuple[int, np.ndarray]:
    """(bits, words): a bitmap of the low ``bits`` bits of the hash ``key`` of the distinct rows of ``df``.

    It has 64 bits or more for each member, from 2**22 to ``2**most_bits`` in all (8 MB), whatever
    the input.  Members are never missed; other keys pass with a probability of 1/64 at most, which
    rises only beyond ``2**most_bits / 64`` (a million) members.
    """
    bits = min(max((64 * df.count()).bit_length(), 22), most_bits)
    pos = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    rows = df.select(pos.alias("p")).select(F.shiftright("p", 6).alias("w"),
                                            F.expr("shiftleft(1L, cast(p & 63 as int))").alias("m"))
    found = rows.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found["w"].to_numpy()] = found["m"].to_numpy()
    return bits, words


def sums_before(rows: DataFrame, group: list[str], index: str, n: str, out: str = "before", block: int = 1024) -> DataFrame:
    """``out``: sum of ``n`` over the group's rows with a smaller ``index``; one row per (group, index) comes in.

    Indices are summed in blocks first, so that no task holds all of a group's rows.
    """
    part = F.floor(F.col(index) / block)
    rows = rows.withColumn("_block", part)
    first = Window.unboundedPreceding
    blocks = (rows.groupBy(*group, "_block").agg(F.sum(n).alias("_sum"))
              .withColumn("_off", F.sum("_sum").over(Window.partitionBy(*group).orderBy("_block").rowsBetween(first, -1)))
              .drop("_sum"))
    for c in [*group, "_block"]:
        blocks = blocks.withColumnRenamed(c, f"_b_{c}")
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in [*group, "_block"]]
    inside = Window.partitionBy(*group, "_block").orderBy(index).rowsBetween(first, -1)
    return (rows.withColumn("_in", F.sum(n).over(inside)).join(blocks, same)
            .withColumn(out, F.coalesce("_in", F.lit(0)) + F.coalesce("_off", F.lit(0)))
            .drop("_in", "_off", "_block", *[f"_b_{c}" for c in [*group, "_block"]]))
