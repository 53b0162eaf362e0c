"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into segments, about as wide as it takes to number the rows; each
segment value leads to the rows that have it.  Two codes that differ by r bits differ by at most r // segments bits in
some segment, so after all segments have been searched to radius s, every code within
``segments * (s + 1) - 1`` bits has been met and verified.  A query's radius grows
until its k-th verified distance is covered; then its result is proven exact.

Index entries are dealt by (segment, high bits of the value), so that a shard is one task's
work; a query goes to the shards whose high bits are within its radius, and each
shard returns at most its k best verified rows for a query.  A crowded shard is cut by a
hash of the id and its queries visit every part.  Only queries that are not proven go
to the next round.

Defined results: ties in distance go to the smaller id; a row is a neighbour of
itself unless ``skip_self``; null elements and not-a-numbers give bit 0; ids are unique
(the caller drops rows without id or vector and keeps one of repeated ids); with
fewer than k rows all are returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BITS = 64
#: Index rows of a shard, on average, and of one part of a crowded shard at most.
SHARD_ROWS = 16_384
PART_ROWS = 65_536


def sign_code(vector: Column) -> Column:
    """64-bit code: bit i is 1 where element i of the vector is above zero; a vector of more than 64 elements is an error."""
    bits = F.transform(F.slice(vector, 1, 64), lambda x, i: F.when(
        F.coalesce((x > 0) & ~F.isnan(x), F.lit(False)), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"a vector has more than {BITS} elements"))).otherwise(code)


def balls(bits: int, radius: int) -> list[np.ndarray]:
    """For each radius up to ``radius``, all masks of exactly that many of ``bits`` bits."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(bits), r)], np.int64) for r in range(radius + 1)]


def segment_bits(rows: int) -> int:
    """Width of a segment: a power of two near log2 of the rows, so that buckets hold few of them."""
    return 8 if rows < 1 << 13 else 16 if rows < 1 << 24 else 32


def first_radius(rows: int, k: int, width: int) -> int:
    """The smallest radius at which codes without any structure would yield k rows; smaller ones prove little."""
    probes, r = 1, 0
    while probes * rows * (BITS // width) < k * 2 ** width and r < width // 2:
        r += 1
        probes += comb(width, r)
    return r


def _per_segment(df: DataFrame, width: int) -> DataFrame:
    def value(j):
        return F.shiftrightunsigned("code", j * width).bitwiseAND(F.lit((1 << width) - 1))

    every = F.array(*[F.struct(F.lit(j).alias("j"), value(j).alias("v")) for j in range(BITS // width)])
    return df.select("*", F.explode(every).alias("seg")).select(*df.columns, "seg.j", "seg.v")


def _probe(index: tuple[np.ndarray, ...], queries: tuple[np.ndarray, ...], k: int, width: int, radius: int):
    """Best k rows (query code, id, distance) of a shard part for each query, from buckets within the radius."""
    v, ids, codes = index
    order = np.argsort(v, kind="stable")
    v, ids, codes = v[order], ids[order], codes[order].view(np.uint64)
    values, low, size = np.unique(v, return_index=True, return_counts=True)
    masks = np.concatenate(balls(width, radius)) if sum(comb(width, r) for r in range(radius + 1)) < len(values) else None
    out = []
    for qv, qcode in zip(*queries, strict=True):
        # the shorter way to the occupied buckets within the radius: flip bits, or test all buckets
        if masks is not None:
            near = np.minimum(np.searchsorted(values, masks ^ qv), len(values) - 1)
            near = near[values[near] == masks ^ qv]
        else:
            near = np.flatnonzero(np.bitwise_count(values ^ qv) <= radius)
        n = size[near]
        n_all = int(n.sum())
        if not n_all:
            continue
        rows = np.repeat(low[near] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n_all)
        d = np.bitwise_count(codes[rows] ^ qcode.view(np.uint64)).astype(np.int64)
        found = ids[rows]
        if len(d) > k:  # all ties of the k-th distance stay for the order by id
            keep = d <= np.partition(d, k - 1)[k - 1]
            d, found = d[keep], found[keep]
        top = np.lexsort((found, d))[:k]
        out += zip([int(qcode)] * len(top), found[top].tolist(), d[top].tolist(), strict=True)
    return out


def _prober(k: int, width: int, radius: int):
    def run(left, right):
        rows = []
        if len(left) and len(right):
            index = tuple(left[c].to_numpy() for c in ("v", "id", "code"))
            queries = tuple(right[c].to_numpy() for c in ("v", "code"))
            rows = _probe(index, queries, k, width, radius)
        return pd.DataFrame(rows, columns=["qcode", "id", "distance"]).astype("int64")
    return run


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, skip_self: bool = True) -> DataFrame:
    """(qid, id, distance, rank): the exact k nearest of stored ``codes`` (id, code) for each of ``queries`` (id, code).

    Of rows with one code only the first can be among the nearest of any query, and
    queries with one code are one search, so groups of equal codes cost no more than one row.
    """
    most = k + 1 if skip_self else k
    alike = Window.partitionBy("code").orderBy("id")
    rows = cut(codes.select("id", "code").withColumn("n", F.row_number().over(alike)).filter(F.col("n") <= most).drop("n"), "rows")
    found = _nearest(rows, queries.select("code").distinct(), most)
    named = queries.select(F.col("id").alias("qid"), "code").join(found, F.col("code") == F.col("qcode"))
    if skip_self:
        named = named.filter(F.col("id") != F.col("qid"))
    order = Window.partitionBy("qid").orderBy("distance", "id")
    return named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("qid", "id", "distance", "rank")


def _nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qcode, id, distance): the exact k nearest of the stored ``rows`` for each distinct query code."""
    total = rows.count()
    width = segment_bits(total)
    high = min(width, max(0, (total // SHARD_ROWS).bit_length()))  # bits of a value that name its shard
    index = _per_segment(rows, width).withColumn("shard", F.shiftright("v", width - high))
    parts = cut(index.groupBy("j", "shard").agg(F.ceil(F.count("*") / F.lit(PART_ROWS)).cast("int").alias("parts")), "parts")
    index = cut(index.join(parts, ["j", "shard"])
                .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts"), "index")
    open_, keys = cut(queries, "queries"), ["j", "shard", "part"]
    n_open, enough, done = open_.count(), min(k, total), None
    for radius in range(first_radius(total, k, width), width + 1):
        # a value within the radius has high bits within the radius
        reach = [int(m) for masks in balls(high, min(radius, high)) for m in masks]
        sent = (_per_segment(open_, width).withColumn("m", F.explode(F.array(*map(F.lit, reach))))
                .withColumn("shard", F.shiftright("v", width - high).bitwiseXOR(F.col("m"))).drop("m")
                .join(parts, ["j", "shard"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
        met = (index.groupBy(*keys).cogroup(sent.groupBy(*keys))
               .applyInPandas(_prober(k, width, radius), "qcode long, id long, distance long").distinct())
        mine = Window.partitionBy("qcode")
        best = (met.withColumn("n", F.row_number().over(mine.orderBy("distance", "id"))).filter(F.col("n") <= k)
                .withColumn("proven", (F.count("*").over(mine) >= enough)
                            & (F.max("distance").over(mine) <= BITS // width * (radius + 1) - 1)))
        best = cut(best, "best").filter("proven").drop("proven", "n")
        done = best if done is None else done.unionByName(best)
        proven = best.select(F.col("qcode").alias("p_code")).distinct()
        n_open -= proven.count()
        if n_open <= 0 or enough <= 0:
            break
        open_ = cut(open_.join(proven, F.col("code") == F.col("p_code"), "left_anti"), "queries")
    return done
