"""Merkle manifest of a table, and proofs by a recursive climb.

Rows are leaves; the leaves of a group (``source``) ascend by id, and every ``FAN``
consecutive nodes have a parent, their digest, until one node is left, the group's
subroot.  The subroots, ordered by group, make a tree of their own, whose top is the root.

The built levels are stored as parent-linked rows.  A row holds the nodes under one
ancestor, ``LEVELS`` levels of them (at most 243 + 81 + 27 + 9 + 3 digests), and names the row
and the place that its ancestor has one step further up.  A Spark recursive query then
ascends from each leaf, one row a step: it folds the (possibly changed) leaf with the
siblings that it meets, and appends those to the leaf's proof.  The query starts with the lowest
rows, which are joined by shuffle; all rows above them together take less than half a byte for each
leaf, so Spark broadcasts them up to its threshold and joins them by shuffle beyond it.

Leaves are numbered by range partitioning, so that a group holding most rows is spread
over many tasks.

Defined results: each field counts as ``-`` where it is null; null ids come first, rows of
one id ascend by their leaf, equal rows stand side by side; a null group is a group and comes
first; a group of one leaf has that leaf as its subroot; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_within_group
from .common import cut

FAN = 3
#: Levels of nodes in one stored row.
LEVELS = 5
SPAN = FAN ** LEVELS
#: The tree of the groups' subroots.
TOP = -1

def _run(level: str, place: str) -> tuple[str, str]:
    """SQL of the siblings before and behind a place of a level."""
    at = f"{place} % {FAN}"
    return (f"slice({level}, CAST({place} - {at} + 1 AS INT), CAST({at} AS INT))",
            f"slice({level}, CAST({place} + 2 AS INT), CAST({FAN - 1} - {at} AS INT))")


BEFORE, BEHIND = _run("level", "up.place")
FOLD = f"""aggregate(n.levels, struct(c.place, c.folded, c.siblings), (up, level) -> struct(
             up.place DIV {FAN} AS place,
             sha2(array_join(concat({BEFORE}, array(up.folded), {BEHIND}), ''), 256) AS folded,
             concat(up.siblings, unhex(array_join(concat({BEFORE}, {BEHIND}), ''))) AS siblings)) AS up,
         n.parent_tree AS tree, n.parent_hop AS hop, n.parent_block AS block, n.parent_place AS place"""
ASCENT = f"""
WITH RECURSIVE climb AS (
  SELECT doc_id, leaf, grp, up, tree, hop, block, place FROM (
    SELECT c.doc_id, c.leaf, c.grp, {FOLD}
    FROM (SELECT doc_id, leaf, grp, given AS folded, CAST('' AS BINARY) AS siblings, pos DIV {SPAN} AS block, pos % {SPAN} AS place
          FROM {{leaves}}) AS c
    JOIN {{low}} AS n ON c.grp = n.tree AND c.block = n.block)
  UNION ALL
  SELECT doc_id, leaf, grp, up, tree, hop, block, place FROM (
    SELECT c.doc_id, c.leaf, c.grp, {FOLD}
    FROM (SELECT doc_id, leaf, grp, up.folded, up.siblings, tree, hop, block, place FROM climb) AS c
    JOIN {{high}} AS n ON c.tree = n.tree AND c.hop = n.hop AND c.block = n.block)
)
SELECT doc_id, leaf, grp, up.folded AS folded_root, sha2(lower(hex(up.siblings)), 256) AS proof_sha256
FROM climb WHERE tree IS NULL
"""


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256)


def _levels(first: Column) -> list[Column]:
    """The array of digests and the ``LEVELS`` levels above it."""
    def above(level: Column) -> Column:
        runs = F.ceil(F.size(level) / F.lit(FAN)).cast("int")
        return F.transform(F.sequence(F.lit(0), runs - 1),
                           lambda i: F.sha2(F.array_join(F.slice(level, i * FAN + 1, F.lit(FAN)), "").cast("binary"), 256))

    return reduce(lambda done, _: [*done, above(F.col(f"_l{len(done) - 1}"))], range(LEVELS), [first])


def _stored_hop(nodes: DataFrame, hop: int, above: int | None) -> DataFrame:
    """Rows of one step: ``nodes`` (tree, pos, digest, n) in blocks of ``SPAN``; ``above``: the tree that the top belongs to."""
    rows = (nodes.groupBy("tree", F.floor(F.col("pos") / SPAN).alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("_run"), F.max("n").alias("n")))
    rows = rows.withColumn("_l0", F.transform("_run", lambda x: x["digest"])).drop("_run")
    for k, level in enumerate(_levels(F.col("_l0"))[1:], 1):
        rows = rows.withColumn(f"_l{k}", level)
    height = reduce(lambda found, k: F.when(F.col("n") <= FAN ** k, F.lit(k)).otherwise(found), reversed(range(LEVELS)), F.lit(LEVELS))
    done, none = F.col("n") <= SPAN, F.lit(None).cast("long")
    next_tree = none if above is None else F.lit(above).cast("long")
    next_at = none if above is None else F.col("tree")
    return cut(rows.withColumn("height", height).select(
        "tree", F.lit(hop).alias("hop"), "block", "n",
        F.slice(F.array(*[F.col(f"_l{k}") for k in range(LEVELS)]), F.lit(1), F.col("height")).alias("levels"),
        F.element_at(F.array(*[F.col(f"_l{k}")[0] for k in range(LEVELS + 1)]), F.col("height") + 1).alias("top"),
        F.when(done, next_tree).otherwise(F.col("tree")).alias("parent_tree"),
        F.when(done, F.lit(0)).otherwise(F.lit(hop + 1)).alias("parent_hop"),
        F.floor(F.when(done, next_at).otherwise(F.col("block")) / SPAN).alias("parent_block"),
        (F.when(done, next_at).otherwise(F.col("block")) % SPAN).alias("parent_place")), "manifest")


def _grow(nodes: DataFrame, largest: int, above: int | None) -> tuple[list[DataFrame], DataFrame]:
    """All stored steps of the trees of ``nodes``, and (tree, top) of each tree."""
    steps = []
    while not steps or largest > SPAN:
        if steps:
            largest = -(-largest // SPAN)
            nodes = steps[-1].filter(F.col("n") > SPAN).select(
                "tree", F.col("block").alias("pos"), F.col("top").alias("digest"), F.ceil(F.col("n") / SPAN).alias("n"))
        steps.append(_stored_hop(nodes, len(steps), above))
    return steps, reduce(DataFrame.unionByName, steps).filter(F.col("n") <= SPAN).select("tree", "top")


def build(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, str | None]:
    """From rows (source, doc_id, leaf, given): numbered leaves, lowest and other node rows, (grp, source, subroot) and the root.

    ``given`` is the leaf that a proof starts from; the tree is made of ``leaf`` alone.
    """
    named = cut(rows.select(F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("name"),
                            "doc_id", "leaf", "given"), "leaves")
    ranked = cut(rank_within_group(named, ["named", "name"], ["doc_id", "leaf", "given"]), "ranked")
    sizes = cut(ranked.filter(F.col("rank") == 1).select("named", "name", F.col("group_size").alias("n"), F.lit(0).alias("all")), "sizes")
    groups = cut(rank_within_group(sizes, ["all"], ["named", "name"]).select(
        (F.col("rank") - 1).alias("grp"), "named", "name", "n"), "groups")
    most = groups.agg(F.count("*").alias("groups"), F.max("n").alias("largest")).first()
    leaves = ranked.join(groups.drop("n"), ["named", "name"]).select("doc_id", "leaf", "given", "grp", (F.col("rank") - 1).alias("pos"),
                                                                     F.col("group_size").alias("n"))
    inner, tops = _grow(leaves.select(F.col("grp").alias("tree"), "pos", F.col("leaf").alias("digest"), "n"), most["largest"] or 0, TOP)
    outer, root = _grow(tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("digest"),
                                    F.lit(most["groups"]).alias("n")), most["groups"], None)
    subroots = tops.withColumnRenamed("tree", "grp").withColumnRenamed("top", "subroot").join(groups, "grp").select(
        "grp", F.when(F.col("named"), F.col("name")).alias("source"), "subroot")
    found = root.first()
    return leaves, inner[0], reduce(DataFrame.unionByName, [*inner[1:], *outer]), subroots, found["top"] if found else None


def climb(leaves: DataFrame, low: DataFrame, high: DataFrame) -> DataFrame:
    """(doc_id, leaf, grp, folded_root, proof_sha256): each leaf's ``given`` digest folded with the siblings on its way to the root."""
    spark = leaves.sparkSession
    # the rows of all steps together; Spark's default stops a recursion at a million
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(ASCENT, leaves=leaves.select("doc_id", "leaf", "given", "grp", "pos"), low=low, high=high)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its line ends where 2 divides the CRC-32 of the id as text."""
    hit = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def verify(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` and each row's proof, folded from the tampered row."""
    ids = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    rows = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf(*ids, text).alias("leaf"),
                       leaf(*ids, tampered(F.col("doc_id"), text)).alias("given"))
    leaves, low, high, subroots, root = build(rows)
    found = climb(leaves, low, high).join(subroots.select("grp", "subroot"), "grp").withColumn("root", F.lit(root).cast("string"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))
