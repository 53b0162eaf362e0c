"""Vector bin packing of text groups into shards.

The unit of placement is a group of equal texts with the vector (bytes, tokens, rows).
Units go, largest first, to the shard where the dot product of the vector with the
residual capacity is highest, among the shards that are about the most open in bytes.  A group of
copies larger than a fraction of a shard is cut into several units, its rows dealt by their
place in the stored table (ids may be missing or repeat).

Units are placed in blocks of bounded size, each with its own share of the residual
capacity, so that placement runs in parallel.  A block must not hold single units that
outweigh its share: units are levelled by size (a factor of ``STEP`` a level), blocks hold
one level, and levels run from heavy to light, each starting from the residual that the
heavier ones left.  What passes between levels is one vector for each shard.

Defined results: a null text counts as an empty one; equal texts share a unit, unless
their group is cut; repeated rows and null ids are placed like any others; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, sums_before

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Units of a block, on average.
BLOCK_UNITS = 8192
#: A unit's choice of shards: open bytes at most this many units below the most open one.
SLACK = 4
#: Factor between the sizes of two levels.
STEP = 16
#: A group of copies beyond this share of a shard's bytes is cut into units of at most that share (or of one row).
CUT_SHARE = 1 / 2


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, key, size, tokens, text_crc32) of each row; equal texts share the key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def run(batches):
        for b in batches:
            texts = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(t) + ROW_BYTES for t in texts], pa.int64()),
                 pa.array([len(t.split()) for t in texts], pa.int64()), pa.array([zlib.crc32(t) for t in texts], pa.int64())],
                ["doc_id", "key", "size", "tokens", "text_crc32"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("key"), text.cast("binary").alias("t")],
                       "doc_id long, key string, size long, tokens long, text_crc32 long", run)


def place(units: np.ndarray, room: np.ndarray, turn: int) -> np.ndarray:
    """Shard of each unit (rows of bytes, tokens, rows), given the shards' residual capacity.

    Residuals and units count in shares of the total.  The law of near-equal bytes comes
    first: a unit may go to the shards whose open bytes are within ``SLACK`` units of the
    most open one, and among these to the highest dot product.
    """
    total = np.maximum(room.sum(axis=0), 1.0)
    left, shares = room / total, units / total
    left = np.roll(left, -turn, axis=0)  # blocks break ties at different shards
    n, out = len(left), np.empty(len(units), np.int64)
    for i in np.lexsort((np.arange(len(units)), -shares[:, 0])).tolist():
        v = shares[i]
        near = left[:, 0] >= left[:, 0].max() - SLACK * v[0]
        k = int(np.where(near, left @ v, -np.inf).argmax())
        left[k] -= v
        out[i] = (k + turn) % n
    return out


def assign(units: DataFrame, shards: int) -> DataFrame:
    """(key, piece, shard) of the stored ``units`` (key, piece, bytes, tokens, rows)."""
    sums = units.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")]).first()
    if not sums["n"]:
        return units.select("key", "piece", F.lit(0).alias("shard"))
    mean = sums["bytes"] / sums["n"]
    level = F.greatest(F.floor(F.log(F.col("bytes") / F.lit(mean)) / F.lit(float(np.log(STEP)))), F.lit(0)).cast("int")
    levelled = cut(units.withColumn("level", level), "levels")
    per = {r["level"]: r for r in levelled.groupBy("level").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")]).collect()}
    dims = ["bytes", "tokens", "rows"]
    room = np.tile(np.array([sums[c] for c in dims], float) / shards, (shards, 1))
    out = None
    for at in sorted(per, reverse=True):
        own = levelled.filter(F.col("level") == at)
        blocks = per[at]["n"] // BLOCK_UNITS + 1
        # the level fills towards the common height, each block with its share of what is open
        goal = _towards(room, np.array([per[at][c] for c in dims], float)) / blocks
        placed = cut(own.withColumn("block", F.pmod(F.xxhash64("key", "piece"), F.lit(blocks)).cast("long"))
                     .groupBy("block").applyInPandas(_placer(goal), "key string, piece int, shard int, bytes long, tokens long, rows long"),
                     "placed")
        used = placed.groupBy("shard").agg(*[F.sum(c).alias(c) for c in dims]).collect()
        for r in used:
            room[r["shard"]] -= [r[c] for c in dims]
        out = placed if out is None else out.unionByName(placed)
    return out.select("key", "piece", "shard")


def _towards(room: np.ndarray, load: np.ndarray) -> np.ndarray:
    """What of a level's ``load`` each shard should take, so that the fullest shards wait."""
    goal = np.empty_like(room)
    for d in range(room.shape[1]):
        low = np.sort(room[:, d])[::-1]
        k = np.arange(1, len(low) + 1)
        height = (np.cumsum(low) - load[d]) / k  # room left where the k most open shards share the load
        best = height[np.flatnonzero(np.append(height[:-1] >= low[1:], True))[0]]
        goal[:, d] = np.maximum(room[:, d] - best, 0)
    return goal


def _placer(goal: np.ndarray):
    def run(pdf):
        pdf = pdf.sort_values(["bytes", "key", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        units = pdf[["bytes", "tokens", "rows"]].to_numpy(float)
        shard = place(units, goal, int(pdf["block"].iloc[0] % len(goal)))
        return pdf.assign(shard=shard.astype(np.int32))[["key", "piece", "shard", "bytes", "tokens", "rows"]]
    return run


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, shard, slot) of each row; slots of a shard are gapless from 0."""
    rows = cut(measured(docs), "measured").withColumn("place", F.monotonically_increasing_id())
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "groups")
    limit = CUT_SHARE * (groups.agg(F.sum("bytes")).first()[0] or 0) / shards
    large = (groups.filter((F.col("bytes") > limit) & (F.col("rows") > 1))
             .select(F.col("key").alias("l_key"), F.least(F.ceil(F.col("bytes") / F.lit(max(limit, 1.0))), "rows").cast("int").alias("pieces")))
    named = (rows.join(large, F.col("key") == F.col("l_key"), "left").drop("l_key")
             .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("place"), F.col("pieces")), F.lit(0)).cast("int")).drop("pieces", "place"))
    named = cut(named, "units")
    units = named.groupBy("key", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    where = assign(cut(units, "unit_sums"), shards).select(F.col("key").alias("w_key"), F.col("piece").alias("w_piece"), "shard")
    put = named.join(where, (F.col("key") == F.col("w_key")) & (F.col("piece") == F.col("w_piece")))
    put = cut(put.select("doc_id", "size", "tokens", "text_crc32", "shard", F.spark_partition_id().alias("part"),
                         F.monotonically_increasing_id().alias("no")), "put")
    # slots: the row's place in its task, after the rows that earlier tasks have of the shard
    before = sums_before(put.groupBy("shard", "part").agg(F.count("*").alias("n")), ["shard"], "part", "n")
    before = before.select(F.col("shard").alias("b_shard"), F.col("part").alias("b_part"), "before")

    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("no")) - 1
    return (put.withColumn("inside", inside)
            .join(before, (F.col("shard") == F.col("b_shard")) & (F.col("part") == F.col("b_part")))
            .select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("inside") + F.col("before")).cast("long").alias("slot")))
