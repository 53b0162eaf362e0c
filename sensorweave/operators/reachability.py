"""Reachability in a hierarchy by interval labels, instead of a stored closure.

Each node takes part in a tree by its smallest parent; it is numbered in preorder (``lo``), and
``hi`` is the last number in its subtree, so "x is below a" is the range test
``lo(a) < lo(x) <= hi(a)``.  Parents beyond the first are kept in a table of their own: x is also
below a where x is in the subtree of such an edge's child, and a is the edge's parent, one of
its ancestors, or reached from there by further such edges.

Preorder is the order of the paths from the root (arrays of ids), ranked by range
partitioning, so a parent of most nodes is no group of one task.  A range join is an
equi-join: an interval is at most two blocks of each power of two, and a number is in one
block of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import rank_within_group
from .rdf import _cut, transitive_closure


def label(edges: DataFrame, child: str = "c", parent: str = "p") -> tuple[DataFrame, DataFrame]:
    """(node, lo, hi) of every node, and the edges (child, parent) beyond each node's first parent.

    One join for each level of the tree.  A hierarchy with a cycle has no preorder and raises an error.
    """
    e = _cut(edges.select(F.col(child).alias("c"), F.col(parent).alias("p")).filter("c is not null and p is not null").distinct())
    first = e.groupBy("c").agg(F.min("p").alias("p"))
    extra = e.join(first.select("c", F.col("p").alias("_p")), "c").filter("p <> _p").select("c", "p")
    tree = _cut(first)
    level = _cut(e.select(F.col("p").alias("node")).distinct().join(tree.select(F.col("c").alias("node")), "node", "left_anti")
                 .select("node", F.array("node").alias("path")))
    paths, n = level, level.count() + tree.count()  # every node is a root or has a first parent
    while True:
        level = _cut(tree.join(level, tree["p"] == level["node"]).select(F.col("c").alias("node"), F.array_append("path", F.col("c")).alias("path")))
        if level.isEmpty():
            break
        paths = paths.unionByName(level)
    if paths.count() < n:
        raise ValueError("the hierarchy has a cycle")
    ranked = _cut(rank_within_group(paths.withColumn("all", F.lit(0)), ["all"], ["path"]).select("node", "path", "rank"))
    sizes = ranked.select(F.explode("path").alias("node")).groupBy("node").agg(F.count("*").alias("size"))
    labels = _cut(ranked.join(sizes, "node").select("node", F.col("rank").alias("lo"), (F.col("rank") + F.col("size") - 1).alias("hi")))
    return labels, _cut(extra)


def within(points: DataFrame, intervals: DataFrame, most: int) -> DataFrame:
    """All columns of ``points`` (with ``at``) and ``intervals`` (with ``lo``, ``hi``), where ``lo <= at <= hi``, numbers up to ``most``.

    Each pair is found once: the blocks of an interval are disjoint.
    """
    levels = max(1, most.bit_length()) + 1
    p = points.select("*", F.posexplode(F.array(*[F.shiftright("at", k) for k in range(levels)])).alias("_k", "_b"))
    step = """aggregate(sequence(0, {n}), struct(lo AS lo, hi AS hi, cast(array() AS array<struct<k: int, b: bigint>>) AS blocks), (a, k) -> struct(
        CASE WHEN a.lo > a.hi THEN a.lo WHEN a.lo % 2 = 1 THEN (a.lo + 1) DIV 2 ELSE a.lo DIV 2 END AS lo,
        CASE WHEN a.lo > a.hi THEN a.hi WHEN a.hi % 2 = 0 THEN a.hi DIV 2 - 1 ELSE a.hi DIV 2 END AS hi,
        CASE WHEN a.lo > a.hi THEN a.blocks ELSE concat(a.blocks,
          CASE WHEN a.lo % 2 = 1 THEN array(struct(k AS k, a.lo AS b)) ELSE array() END,
          CASE WHEN a.hi % 2 = 0 AND NOT (a.lo % 2 = 1 AND a.lo = a.hi) THEN array(struct(k AS k, a.hi AS b)) ELSE array() END) END AS blocks),
        a -> a.blocks)""".format(n=levels - 1)
    i = intervals.select("*", F.inline(F.expr(step))).withColumnRenamed("k", "_ik").withColumnRenamed("b", "_ib")
    return p.join(i, (F.col("_k") == F.col("_ik")) & (F.col("_b") == F.col("_ib"))).drop("_k", "_b", "_ik", "_ib")


def below(labels: DataFrame, extra: DataFrame) -> DataFrame:
    """All (node, above) pairs: the membership of every node, found by range tests."""
    most = labels.agg(F.max("lo")).first()[0] or 0
    points = labels.select("node", F.col("lo").alias("at"))
    tree = within(points, labels.select(F.col("node").alias("above"), F.col("lo"), F.col("hi")), most).filter("node <> above").select("node", "above")
    if extra.isEmpty():
        return tree
    edges = _cut(extra.select(F.xxhash64("c", "p").alias("e"), "c", "p"))
    span = labels.withColumnRenamed("node", "n")
    child = edges.join(span, F.col("c") == F.col("n")).select("e", "lo", "hi")  # the subtree that the edge lifts
    parent = edges.join(span, F.col("p") == F.col("n")).select("e", F.col("lo").alias("at"))
    # an edge leads on to the edges whose subtree its parent is in
    on = within(parent, child.withColumnRenamed("e", "f"), most).select(F.col("e").alias("c"), F.col("f").alias("p"))
    chains = edges.select(F.col("e").alias("c"), F.col("e").alias("p")).unionByName(transitive_closure(on)).distinct()
    lifted = within(points, child, most).select("node", F.col("e").alias("c"))
    above = within(parent, labels.withColumnRenamed("node", "above"), most).select(F.col("e").alias("p"), "above")
    return tree.unionByName(lifted.join(chains, "c").join(above, "p").select("node", "above")).distinct()


def is_below(pairs: DataFrame, labels: DataFrame, node: str = "node", above: str = "above") -> DataFrame:
    """``pairs`` with ``below``: the range test on the tree for each of the given pairs, two joins on the labels."""
    a = labels.select(F.col("node").alias(node), F.col("lo").alias("_at"))
    b = labels.select(F.col("node").alias(above), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    return (pairs.join(a, node, "left").join(b, above, "left")
            .withColumn("below", F.coalesce((F.col("_at") > F.col("_lo")) & (F.col("_at") <= F.col("_hi")), F.lit(False)))
            .drop("_at", "_lo", "_hi").select(*pairs.columns, "below"))
