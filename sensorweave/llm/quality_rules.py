"""Quality rules with adaptive thresholds, in DataFrame operations only.

A few features of each text are held against fences that the corpus sets itself, for
each language and source.  Every feature is an integer, and its distribution is kept
as a log-linear histogram (32 steps an octave, at most 3 % relative error): a quantile
sketch of bounded size that merges by adding counts, in any order with one result.  The
sketches of a language are the merged sketches of its sources, and a group with too few
documents takes its language's, then the corpus's thresholds.  A feature is out of
bounds beyond quartile + ``reach`` * spread, the spread being the interquartile range or
the feature's least spread.  Thresholds are joined to the documents, which then filter.

Defined results: a null or empty text has no words and fails the base rules; null
language or source are groups of their own; repeated rows share their result and count
each; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: feature -> (expression in thousandths over the counts, whether low values fail too, least spread)
FEATURES = {
    "symbols": ("1000 * n_symbols div n_words", False, 30),
    "marks": ("1000 * n_marks div n_words", False, 100),
    "capitals": ("1000 * n_capitals div greatest(word_chars, 1)", False, 30),
    "length": ("1000 * word_chars div n_words", True, 600),
    "same_lines": ("1000 * n_dup_lines div greatest(n_lines, 1)", False, 120),
    "repeats": ("1000 * n_repeat_words div n_words", False, 100),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals", "n_lines"]


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, the COUNTS) of each row, over its whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = docs.select(
        "doc_id", "lang", "source",
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        *[F.regexp_count(text, F.lit(p)).cast("long").alias(c) for c, p in (
            ("n_symbols", r"[#*$%&|<>]"), ("n_marks", r"[^\p{L}\p{N}\x20\x09-\x0D]"), ("n_capitals", r"\p{Lu}"))])
    words = F.col("words")
    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                          lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    two = one.select(
        "doc_id", "lang", "source", "n_symbols", "n_marks", "n_capitals",
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("windows"))
    # only texts with a repeated window go on: windows sorted by hash, those with an equal neighbour, by position
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    three = two.withColumn("byhash", F.when(again, F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def beside(x: Column, j: Column) -> Column:
        near = F.get(F.col("byhash"), j - 1)["h"], F.get(F.col("byhash"), j + 1)["h"]
        return F.coalesce(near[0] == x["h"], F.lit(False)) | F.coalesce(near[1] == x["h"], F.lit(False))

    four = three.withColumn("at", F.array_sort(F.transform(F.filter("byhash", beside), lambda x: x["i"])))
    fresh = F.transform("at", lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(F.col("at"), k - 1))))
    repeat = F.coalesce(F.aggregate(fresh, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return four.withColumn("n_repeat_words", repeat).select("doc_id", "lang", "source", *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bucket(v: Column) -> Column:
    """Lower edge of the log-linear histogram bucket of a value from 0."""
    bits = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, bits), bits)


def features() -> Column:
    return F.array(*[F.struct(F.lit(k).alias("feature"), F.expr(e).cast("long").alias("v")) for k, (e, _, _) in FEATURES.items()])


def thresholds(docs: DataFrame, reach: float, least_docs: int) -> DataFrame:
    """(lang, source, <feature>_low, <feature>_high): the fences of each language and source."""
    values = docs.filter(~base_failed()).select("lang", "source", F.explode(features()).alias("f")).select("lang", "source", "f.*")
    own = values.groupBy("lang", "source", "feature", bucket(F.col("v")).alias("b")).agg(F.count("*").alias("n"))
    own = cut(own, "sketches")
    # a sketch merges by adding counts
    of_lang = own.groupBy("lang", "feature", "b").agg(F.sum("n").alias("n"))
    of_all = of_lang.groupBy("feature", "b").agg(F.sum("n").alias("n"))
    fences = [_fences(s, keys, reach) for s, keys in ((own, ["lang", "source"]), (of_lang, ["lang"]), (of_all, []))]
    groups = docs.select("lang", "source").distinct()
    for k, f in enumerate(fences):
        keys = ["lang", "source"][:2 - k]
        f = f.filter(F.col("total") >= least_docs) if keys else f
        f = f.select(*[F.col(c).alias(f"k{k}_{c}") for c in keys], F.struct(*[c for c in f.columns if c[-4:] in ("_low", "high")]).alias(f"f{k}"))
        on = [F.col(c).eqNullSafe(F.col(f"k{k}_{c}")) for c in keys]
        groups = (groups.join(f, on, "left") if keys else groups.crossJoin(F.broadcast(f))).drop(*[f"k{k}_{c}" for c in keys])
    return groups.select("lang", "source", F.coalesce("f0", "f1", "f2").alias("f")).select("lang", "source", "f.*")


def _fences(sketch: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """One row for each group: total documents, and each feature's fences from its quartiles."""
    w = Window.partitionBy(*keys, "feature")
    ranked = (sketch.withColumn("upto", F.sum("n").over(w.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("total", F.sum("n").over(w)))

    def quartile(f: str, k: int) -> Column:
        return F.min(F.when((F.col("feature") == f) & (4 * F.col("upto") >= k * F.col("total")), F.col("b")))

    aggs = [F.max("total").alias("total")]
    for f in FEATURES:
        aggs += [quartile(f, 1).alias(f"{f}_q1"), quartile(f, 3).alias(f"{f}_q3")]
    rows = ranked.groupBy(*keys).agg(*aggs)
    out = [*keys, "total"]
    for f, (_, both, least) in FEATURES.items():
        spread = F.greatest(F.col(f"{f}_q3") - F.col(f"{f}_q1"), F.lit(least)) * reach
        out += [(F.col(f"{f}_q1") - spread if both else F.lit(-1.0)).cast("double").alias(f"{f}_low"),
                (F.col(f"{f}_q3") + spread).cast("double").alias(f"{f}_high")]
    return rows.select(*out)


def apply(docs: DataFrame, reach: float = 3.0, least_docs: int = 50) -> DataFrame:
    """(doc_id, lang, source, the COUNTS, base_failed, kept) of each row of ``docs`` (doc_id, text, lang, source)."""
    found = cut(counted(docs), "counts")
    fences = thresholds(found, reach, least_docs)
    fences = fences.withColumnRenamed("lang", "t_lang").withColumnRenamed("source", "t_source")
    joined = found.join(fences, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    inside = F.lit(True)
    for f, (e, _, _) in FEATURES.items():
        inside &= F.coalesce(F.expr(e).cast("double").between(F.col(f"{f}_low"), F.col(f"{f}_high")), F.lit(True))
    return joined.select("doc_id", "lang", "source", *COUNTS, base_failed().alias("base_failed"),
                         F.when(base_failed(), F.lit(False)).otherwise(inside).alias("kept"))
