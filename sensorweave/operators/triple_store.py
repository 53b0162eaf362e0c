"""Triples on ids: a term dictionary and one narrow table of longs for each predicate.

A node (IRI or blank node) is a 64-bit id, the hash of its term, so no join is needed to
encode.  The dictionary (id, term) is a distinct over all node terms, stored without the ids, which
are hashed again as it is read.  Building it shows the terms whose hashes collide, and each of these
but the first gets another id, which the facts then take from a join with those few terms.  So ids
are exact, whatever the size.

Facts are stored partitioned by predicate: (s, o) where the object is a node, (s, text) where
it is a literal.  A pattern reads one partition and two columns; joins, list walks and
folds compare longs, and ``decode`` brings terms back at the end, for the ids that are left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .rdf import ROWS_A_TASK, hash_join, is_node, open_writers, shuffles_dropped


def hash_id(term: Column, attempt: int = 0) -> Column:
    return F.xxhash64(term) if not attempt else F.xxhash64(term, F.lit(attempt))


def _spare_ids(hashed: DataFrame, hash_fn) -> DataFrame:
    """(term, id) of every term but the first of those that share a hash; ids that no other term has."""
    spark = hashed.sparkSession

    def standing_twice(batches):  # a task has all rows of an id
        ids = np.sort(np.concatenate([np.zeros(0, np.int64), *[b.column(0).to_numpy(zero_copy_only=False) for b in batches]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(ids[1:][ids[1:] == ids[:-1]]), pa.int64())], ["id"])

    # the ids alone are counted; terms are looked at only where an id stands twice, which is next to never.  Nearly all
    # ids differ, so they are dealt uncounted, to as many tasks as keep a task's ids in its memory
    with shuffles_dropped(spark):
        dealt = hashed.select("id").repartition(hashed.count() // ROWS_A_TASK + 1, "id")
        twice = [r["id"] for r in dealt.mapInArrow(standing_twice, "id long").collect()]
    if not twice:
        return spark.createDataFrame([], "term string, id long")
    shared = hashed.join(F.broadcast(spark.createDataFrame([(i,) for i in twice], "id long")), "id")
    first = shared.groupBy("id").agg(F.min("term").alias("first"))
    left = [r["term"] for r in shared.join(first, "id").filter("term <> first").select("term").collect()]
    given: dict[int, str] = {}
    attempt = 0
    while left:  # as few as two equal 64-bit hashes are: about n * n / 2**65 of n terms
        attempt += 1
        tried = spark.createDataFrame([(t,) for t in left], "term string").withColumn("id", hash_fn(F.col("term"), attempt))
        free = tried.join(hashed.select("id"), "id", "left_anti").collect()
        for r in free:
            given.setdefault(r["id"], r["term"])
        left = [t for t in left if t not in set(given.values())]
    return spark.createDataFrame([(t, i) for i, t in given.items()], "term string, id long")


class TripleStore:
    """The stored tables under ``root``: ``facts`` (s, o, text, p), ``terms`` (term), whose ids are their hashes, but
    for those in ``spare`` (term, id)."""

    def __init__(self, spark: SparkSession, root: str, hash_fn=hash_id):
        self.spark, self.root, self.hash_fn = spark, root, hash_fn
        self.facts = spark.read.parquet(f"{root}/facts")
        hashed, spare = self._hashed(spark, root, hash_fn), spark.read.parquet(f"{root}/spare")
        self.spare = {r["term"]: r["id"] for r in spare.collect()}
        self.terms = hashed if not self.spare else hashed.join(spare.select("term"), "term", "left_anti").select("id", "term").unionByName(
            spare.select("id", "term"))

    @staticmethod
    def _hashed(spark: SparkSession, root: str, hash_fn) -> DataFrame:
        """(id, term): a hash does not compress, and is soon made again."""
        return spark.read.parquet(f"{root}/terms").select(hash_fn(F.col("term")).alias("id"), "term")

    @classmethod
    def build(cls, triples: DataFrame, root: str | None = None, hash_fn=hash_id) -> TripleStore:
        """Encode (s, p, o) with an optional ``o_kind``; an object is a literal where that says so, else where
        it reads neither as an IRI nor as a blank node."""
        spark = triples.sparkSession
        root = root or scratch_path(spark, "triple-store")
        o = F.col("o")
        literal = F.col("o_kind") == "literal" if "o_kind" in triples.columns else ~is_node(o)
        rows = triples.select("s", "p", F.when(~literal, o).alias("o"), F.when(literal, o).alias("text"))
        # read twice, as rows kept between the passes would fill the memory that the passes need
        nodes = rows.select(F.explode(F.array("s", "o")).alias("term")).filter("term is not null").distinct()
        with shuffles_dropped(spark):
            nodes.write.option("compression", "zstd").parquet(f"{root}/terms")
        spare = _spare_ids(cls._hashed(spark, root, hash_fn), hash_fn)
        spare.write.parquet(f"{root}/spare")
        renamed = not spare.isEmpty()

        def encoded(df, c):
            plain = F.when(F.col(c).isNotNull(), hash_fn(F.col(c)))
            if not renamed:
                return df.withColumn(c, plain)
            own = F.broadcast(spare.select(F.col("term").alias(c), F.col("id").alias(f"_{c}")))
            return df.join(own, c, "left").withColumn(c, F.coalesce(f"_{c}", plain)).drop(f"_{c}")

        with open_writers(spark):
            (encoded(encoded(rows, "s"), "o").select("s", "o", "text", "p")
             .write.partitionBy("p").parquet(f"{root}/facts"))
        return cls(spark, root, hash_fn)

    def node(self, term: str) -> Column:
        """The id of a term."""
        return F.lit(self.spare[term]) if term in self.spare else self.hash_fn(F.lit(term))

    def pred(self, p: str, s: str = "s", o: str = "o") -> DataFrame:
        """Facts of one predicate whose object is a node, as two columns of ids."""
        return self.facts.filter((F.col("p") == p) & F.col("o").isNotNull()).select(F.col("s").alias(s), F.col("o").alias(o))

    def text(self, p: str, s: str = "s", o: str = "o") -> DataFrame:
        """Facts of one predicate whose object is a literal: subject id and text."""
        return self.facts.filter((F.col("p") == p) & F.col("text").isNotNull()).select(F.col("s").alias(s), F.col("text").alias(o))

    def decode(self, df: DataFrame, *columns: str, large: bool = False) -> DataFrame:
        """``df`` with the ids in ``columns`` replaced by their terms; every id is in the dictionary.

        The inner join lets the planner broadcast a small ``df``, so that the dictionary stays where it is; what
        is small only once it is computed (a distinct, an aggregate) is best stored first.  A ``large`` one, of
        about as many rows as the dictionary, is joined without sorting either.
        """
        most = self.terms.count() if large else 0
        for c in columns:
            terms = self.terms.select(F.col("id").alias(c), F.col("term").alias("_term"))
            df = (hash_join(df, terms, c, most) if large else df.join(terms, c)).withColumn(c, F.col("_term")).drop("_term").select(*df.columns)
        return df
