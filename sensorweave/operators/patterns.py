"""Graph pattern matching on edge tables: hops, chains, bounded paths, unions.

A pattern ``(a)-[:T]->(b)`` is an inner equi-join node-edge-node; one output
row per matched edge combination (Cypher row semantics).  Joins carry no
broadcast hint: AQE measures each side at run time and broadcasts only a side
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; larger sides stay
shuffle joins, and skewed keys are split by AQE's skew-join handling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_hop(src: DataFrame, src_key: list[str], edges: DataFrame, edge_src: list[str],
            edge_dst: list[str], dst: DataFrame, dst_key: list[str]) -> DataFrame:
    """``(src)-[e]->(dst)``: join src-edge on src key, edge-dst on dst key."""
    e = edges
    for a, b in zip(src_key, edge_src):
        if a != b:
            src = src.withColumnRenamed(a, b)
    left = e.join(src, on=edge_src, how="inner")
    for a, b in zip(dst_key, edge_dst):
        if a != b:
            dst = dst.withColumnRenamed(a, b)
    return left.join(dst, on=edge_dst, how="inner")


def paths_up_to(edges: DataFrame, max_hops: int = 3) -> DataFrame:
    """All directed paths of 1..max_hops edges, an edge used at most once per path.

    ``edges`` needs columns (edge_id, src, dst, type).  Each extra hop is one
    equi-join of the path frontier with the edge table on the frontier's end
    node; the output is (hops, start, end, path, types) with ``path`` the node
    sequence joined by '->'.
    """
    e = edges.select("edge_id", "src", "dst", "type")
    frontier = e.select(
        F.lit(1).alias("hops"), F.col("src").alias("start"), F.col("dst").alias("end"),
        F.array(F.col("edge_id")).alias("edge_ids"),
        F.array(F.col("src"), F.col("dst")).alias("nodes"),
        F.array(F.col("type")).alias("types"))
    out = [frontier]
    for _ in range(2, max_hops + 1):
        nxt = e.select(F.col("edge_id").alias("_eid"), F.col("src").alias("end"),
                       F.col("dst").alias("_dst"), F.col("type").alias("_type"))
        frontier = (frontier.join(nxt, on="end", how="inner")
                    .filter(~F.array_contains(F.col("edge_ids"), F.col("_eid")))
                    .select((F.col("hops") + 1).alias("hops"), "start", F.col("_dst").alias("end"),
                            F.array_append("edge_ids", F.col("_eid")).alias("edge_ids"),
                            F.array_append("nodes", F.col("_dst")).alias("nodes"),
                            F.array_append("types", F.col("_type")).alias("types")))
        out.append(frontier)
    allp = reduce(lambda a, b: a.unionByName(b), out)
    return allp.select("hops", "start", "end",
                       F.array_join("nodes", "->").alias("path"),
                       F.array_join("types", ",").alias("types"))


def _product(left: DataFrame, right: DataFrame, bound: int) -> DataFrame:
    """(start, end, n): ``left`` (start, mid, n) times ``right`` (mid, end, n), summed by endpoint pair.

    A middle node whose two sides would meet in more than ``bound`` rows is split: its left rows are
    dealt over several salts, and its right rows go to each of them.
    """
    ins = left.groupBy("mid").agg(F.count("*").alias("_in"))
    outs = right.groupBy("mid").agg(F.count("*").alias("_out"))
    hubs = (ins.join(outs, "mid").select("mid", F.least(F.ceil(F.col("_in") * F.col("_out") / F.lit(bound)), F.col("_in")).cast("int").alias("_salts"))
            .filter("_salts > 1"))
    salts = F.coalesce("_salts", F.lit(1))
    a = left.join(hubs, "mid", "left").select("start", "mid", F.col("n").alias("_n"), F.pmod(F.xxhash64("start"), salts).cast("int").alias("_salt"))
    b = right.join(hubs, "mid", "left").select("mid", "end", "n", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return a.join(b, ["mid", "_salt"]).groupBy("start", "end").agg(F.sum(F.col("_n") * F.col("n")).alias("n"))


def path_counts(edges: DataFrame, bound: int = 10_000_000) -> DataFrame:
    """J10 without the paths: (hops, start, end, n), the number of directed paths of 1, 2 and 3 edges by endpoint
    pair, an edge used at most once per path.

    ``edges``: (src, dst), one row for each edge; parallel edges are edges of their own.  Paths with
    repeated edges are counted by products as well and taken off again: with c(s, t) edges and l(s) loops,

      2 edges: sum c(s, m) c(m, t)            less l(s) where s = t
      3 edges: sum c(s, m) c(m, n) c(n, t)    less c(s, t) (l(s) + l(t) + c(t, s)), plus 2 l(s) where s = t

    so nothing larger than the result and the 2-edge pairs is ever built.
    """
    one = edges.groupBy(F.col("src").alias("start"), F.col("dst").alias("end")).agg(F.count("*").alias("n"))
    left, right = one.withColumnRenamed("end", "mid"), one.withColumnRenamed("start", "mid")
    two_all = _product(left, right, bound)
    three_all = _product(two_all.withColumnRenamed("end", "mid"), right, bound)
    loops = one.filter(F.col("start") == F.col("end")).select(F.col("start").alias("_x"), F.col("n").alias("_l"))
    two = two_all.join(loops, (F.col("start") == F.col("_x")) & (F.col("end") == F.col("_x")), "left").select(
        "start", "end", (F.col("n") - F.coalesce("_l", F.lit(0))).alias("n"))
    back = one.select(F.col("start").alias("_e"), F.col("end").alias("_s"), F.col("n").alias("_back"))
    at_start, at_end = (loops.select(F.col("_x").alias(f"_{c}x"), F.col("_l").alias(f"_{c}l")) for c in ("s", "e"))
    none = F.lit(0)
    repeated = (one.join(back, (F.col("start") == F.col("_s")) & (F.col("end") == F.col("_e")), "left")
                .join(at_start, F.col("start") == F.col("_sx"), "left").join(at_end, F.col("end") == F.col("_ex"), "left")
                .select(F.col("start").alias("_rs"), F.col("end").alias("_re"), (
                    F.col("n") * (F.coalesce("_sl", none) + F.coalesce("_el", none) + F.coalesce("_back", none))
                    - F.when(F.col("start") == F.col("end"), 2 * F.col("n")).otherwise(none)).alias("_r")))
    three = three_all.join(repeated, (F.col("start") == F.col("_rs")) & (F.col("end") == F.col("_re")), "left").select(
        "start", "end", (F.col("n") - F.coalesce("_r", none)).alias("n"))
    counted = reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("hops"), "start", "end", "n") for k, df in enumerate((one, two, three), 1)])
    return counted.filter("n > 0")
