"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

The documents of a source are shuffled by a hash of their id and offered up to
``repeats`` times.  Each copy has a virtual finish time: the source's words up to
and with it, divided by the source's weight.  All copies are then ordered by
finish time and the order is truncated at the total budget (all words of the
input).  A source that runs out stops by itself and the others share what it leaves,
which is what resharing its excess by weight gives.

Prefix sums never gather a source in one task: hashes are cut into equal ranges,
each range is summed where it lies and the sums of earlier ranges (one row each)
are added.  The global order is cut into equal spans of virtual time likewise.

Defined results: a null text has size 0; sources sort by code point with null last;
repeated rows are documents of their own; an empty table gives an empty result; a
copy of size 0 is free, and every document of size 0 is taken with nothing. Ties in
virtual time go by source, hash and id.  Extra columns are ignored by ``mix`` and
passed through by ``resample``.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, sums_before

WEIGHTS = (5, 2, 1)
#: Documents of a hash range, and of a span of virtual time, on average.
RANGE_ROWS = 2048


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3) -> DataFrame:
    """(source, n, source_size, rank, weight, target) of each source, from (source, size) rows.

    Sources under their cap share what is left by weight until none is above its cap;
    each round is one aggregate over the sources.
    """
    known = F.col("source").isNull()
    totals = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
              .withColumn("rank", F.row_number().over(Window.orderBy(known, "source")) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    totals = cut(totals.withColumn("weight", weight.cast("long")), "sources")
    cap = F.col("source_size") * repeats
    budget = totals.agg(F.sum("source_size")).first()[0] or 0
    full = F.lit(False)
    level = 0.0
    while True:
        got = totals.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))),
                         F.sum(full.cast("long"))).first()
        if not got[1]:
            break
        level = (budget - got[0]) / got[1]
        above = full | (F.col("weight") * F.lit(level) > cap)
        if totals.filter(above).count() == (got[2] or 0):
            break
        full = above
    return totals.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(level)).cast("double"))


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3) -> DataFrame:
    """``rows`` (doc_id, source, size, any others) with source_size, target, copies and taken."""
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 12), 16, 10).cast("long")
    docs = cut(rows.withColumn("_hash", hashed), "sizes")
    sources = source_targets(docs.select("source", "size"), weights, repeats)
    unit = lcm(*weights)
    found = sources.agg(F.sum("n"), F.sum("source_size"), F.max(F.col("target") * unit / F.col("weight"))).first()
    count, budget, end = found[0] or 0, found[1] or 0, found[2] or 0
    ranges = count // RANGE_ROWS + 1

    # words of the source up to and with each document: earlier hash ranges, then inside the range
    ranged = docs.withColumn("_range", F.floor(F.col("_hash") / F.lit((1 << 48) / ranges)).cast("long"))
    sums = sums_before(ranged.groupBy("source", "_range").agg(F.sum("size").alias("_s")), ["source"], "_range", "_s")
    sums = sums.select(F.col("source").alias("_src"), F.col("_range").alias("_rng"), "before")
    named = sources.select(F.col("source").alias("_src"), "source_size", "rank", "weight", "target")
    first = Window.unboundedPreceding
    inside = Window.partitionBy("source", "_range").orderBy("_hash", "doc_id", "size").rowsBetween(first, 0)
    placed = (ranged.withColumn("_upto", F.sum("size").over(inside))
              .join(sums, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_range") == F.col("_rng")))
              .withColumn("_upto", F.col("_upto") + F.col("before")).drop("_src", "_rng", "before", "_range")
              .join(named, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
              .withColumn("_no", F.monotonically_increasing_id()))
    placed = cut(placed, "placed")

    # each copy's virtual finish time, exact in units of 1 / lcm of the weights
    per = (F.lit(unit) / F.col("weight")).cast("long")
    copies = (placed.filter("size > 0")
              .select("_no", "size", "rank", "_hash", "doc_id", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"),
                      "source_size", "_upto", per.alias("per"))
              .select("_no", "size", "rank", "_hash", "doc_id", "turn",
                      ((F.col("turn") * F.col("source_size") + F.col("_upto")) * F.col("per")).alias("finish"))
              .withColumn("span", F.floor(F.col("finish") / F.lit(max(1.0, end / (4 * ranges)))).cast("long")))
    spans = sums_before(copies.groupBy("span").agg(F.sum("size").alias("_s")).withColumn("_all", F.lit(0)), ["_all"], "span", "_s")
    spans = spans.filter(F.col("before") < budget).select(F.col("span").alias("_span"), "before")
    order = Window.partitionBy("span").orderBy("finish", "rank", "_hash", "doc_id", "_no").rowsBetween(first, 0)
    taken = (copies.join(spans, F.col("span") == F.col("_span"))
             .withColumn("at", F.col("before") + F.sum("size").over(order)).filter(F.col("at") <= budget)
             .groupBy(F.col("_no").alias("_row")).agg(F.count("*").alias("copies")))
    return (placed.join(taken, F.col("_no") == F.col("_row"), "left")
            .drop("_row", "_no", "_hash", "_upto", "rank", "weight")
            .withColumn("copies", F.when(F.col("size") == 0, 1).otherwise(F.coalesce("copies", F.lit(0))).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def resample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = 3) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as the mix has it, none to ``repeats`` times.

    ``docs`` must be a stored table as read: a row's place in the scan names it, and
    a hash of its content proves that both passes met the same row.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    place, proof = F.monotonically_increasing_id(), F.xxhash64("doc_id", "source", "text")
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                        place.alias("__place"), proof.alias("__proof"))
    copies = mix(sizes, weights, repeats).filter("copies > 0").select(
        F.col("__place").alias("__p"), F.col("__proof").alias("__h"), F.col("copies").alias("__copies"))
    joined = docs.select(*own, place.alias("__place"), proof.alias("__proof")).join(copies, F.col("__place") == F.col("__p"))
    times = F.when(F.col("__proof") == F.col("__h"), F.col("__copies")).otherwise(
        F.raise_error(F.lit("the table changed between two passes")).cast("long"))
    return joined.withColumn("__turn", F.explode(F.sequence(F.lit(1), times))).select(*own)
