"""Hard negatives by exact integer scores from Kronecker-packed products.

Vectors are scaled to integers.  Component j of several candidates is biased to be
non-negative and put into separated fields of one wide integer; one multiplication by the
anchor's (biased) component j is the product for all of them, and the sum over j holds all
scores, which shifts and masks unpack.  The biases are taken off again by the sums of the
components.  A field is wide enough for the largest sum, so no field runs into the next one:
64-bit words hold two or three fields for components of ordinary size; vectors with larger
components go through Python's integers, packed in the same way, with fields as wide as they need.

Two passes over (part of the candidates) x (part of the anchors), each pair of parts one
group: the first meets an anchor with the parts that hold its label and keeps its best positives;
the second meets it with all parts and keeps, for each positive, the best rows of other labels
within the positive's score range.  Each group returns at most the rows asked for, and
they are merged by rank.  Parts have a bounded size: a label of a third of all rows is many parts.

Defined results: rows with a null label or vector, or a null or non-finite component take no
part; a missing component counts as zero, so vectors of different lengths can meet; rows
without an id are candidates, behind others of their score, and no anchors; repeated rows are rows of
their own, and only the row itself is no positive of it; scores beyond 64 bits are compared
exactly and returned as the nearest 64-bit value; the largest 64-bit id counts as none; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Components are scaled by this and rounded down.
SCALE = 256
#: Candidates and anchors of a part, about.
PART_ROWS = 16_384
ANCHOR_ROWS = 8_192
#: Larger components go through Python's integers.
NARROW = 1 << 12
#: Fields of a Python integer.
WIDE_FIELDS = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Stands for a missing id; comes last in ties.
NO_ID = MOST


def usable(vector: Column, label: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return label.isNotNull() & vector.isNotNull() & ~bad


def _matrix(vectors) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Packed:
    """Candidates in packed words; ``scores`` are exact for components below ``NARROW``."""

    def __init__(self, rows: np.ndarray, most: int):
        """``rows``: integers (candidate, component); ``most``: the largest biased component of an anchor."""
        self.n, self.width = rows.shape
        self.bias = -int(rows.min(initial=0))
        biased = (rows + self.bias).astype(np.uint64)
        top = max(1, int(biased.max(initial=0)) * most)
        # three fields if at least 16 products fit into one of 21 bits, else two
        self.fields = 3 if 16 * top < 1 << 21 else 2
        self.bits = 64 // self.fields
        self.run = max(1, ((1 << self.bits) - 1) // top)  # components that a field can sum
        self.sums = rows.sum(axis=1)
        cells = -(-self.n // self.fields)
        wide = np.zeros((self.width, cells * self.fields), np.uint64)
        wide[:, :self.n] = biased.T
        wide = wide.reshape(self.width, self.fields, cells)
        shift = np.arange(self.fields, dtype=np.uint64) * np.uint64(self.bits)
        self.words = np.bitwise_or.reduce(wide << shift[None, :, None], axis=1)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        low = -int(anchor.min(initial=0))
        factors = (anchor + low).astype(np.uint64)
        total = np.zeros(self.words.shape[1] * self.fields, np.int64)
        mask, product = np.uint64((1 << self.bits) - 1), np.empty(self.words.shape[1], np.uint64)
        for at in range(0, self.width, self.run):
            packed = np.zeros(self.words.shape[1], np.uint64)
            for j in range(at, min(at + self.run, self.width)):
                np.multiply(self.words[j], factors[j], out=product)
                packed += product
            total += np.concatenate([(packed >> np.uint64(f * self.bits)) & mask for f in range(self.fields)]).astype(np.int64)
        # (x + bias)(a + low) summed, less what the biases added
        return total[:self.n] - low * self.sums - self.bias * int(anchor.sum()) - self.width * low * self.bias


class WidePacked:
    """The same with Python's integers, for components of any size."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        self.bias = -min([0, *(min(r, default=0) for r in rows)])
        self.top = max([1, *(max(r, default=0) + self.bias for r in rows)])

    def scores(self, anchor: list[int]) -> list[int]:
        low = -min([0, *anchor])
        bits = (len(anchor) * self.top * (max([0, *anchor]) + low) + 1).bit_length()
        mask, out, off = (1 << bits) - 1, [], sum(anchor) * self.bias + len(anchor) * low * self.bias
        for at in range(0, len(self.rows), WIDE_FIELDS):
            some, packed = self.rows[at:at + WIDE_FIELDS], 0
            for j, a in enumerate(anchor):
                word = sum((r[j] + self.bias) << (i * bits) for i, r in enumerate(some))
                packed += word * (a + low)
            out += [((packed >> (i * bits)) & mask) - low * sum(r) - off for i, r in enumerate(some)]
        return out


def whole(x: float) -> int:
    """``floor(SCALE * x)``, exactly."""
    return math.floor(SCALE * x) if abs(x) < 1 << 52 else int(x) * SCALE


class Scorer:
    """Scores of anchors against a part: narrow with narrow in 64-bit words, all others in wide integers."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        width = max(rows.shape[1], anchors.shape[1])
        self.rows, self.anchors = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, anchors))
        with np.errstate(over="ignore"):
            small, own = np.floor(SCALE * self.rows), np.floor(SCALE * self.anchors)
        self.narrow, self.fits = (np.abs(x).max(axis=1, initial=0) < NARROW for x in (small, own))
        self.factors = np.where(self.fits[:, None], own, 0).astype(np.int64)
        self.packed = Packed(small[self.narrow].astype(np.int64), max(1, int(self.factors.max(initial=0)) - int(self.factors.min(initial=0))))
        self.wide = WidePacked([[whole(x) for x in r] for r in self.rows[~self.narrow].tolist()])
        self.every = None

    def scores(self, i: int) -> np.ndarray:
        """Scores of all candidates for anchor ``i``: 64-bit integers, or Python's where those may not do."""
        if self.fits[i] and self.narrow.all():
            return self.packed.scores(self.factors[i])
        out, anchor = np.empty(len(self.rows), object), [whole(x) for x in self.anchors[i].tolist()]
        if self.fits[i]:
            out[self.narrow] = self.packed.scores(self.factors[i]).tolist()
            out[~self.narrow] = self.wide.scores(anchor)
        else:
            self.every = self.every or WidePacked([[whole(x) for x in r] for r in self.rows.tolist()])
            out[:] = self.every.scores(anchor)
        return out


def _best(scores: np.ndarray, ids: np.ndarray, keep: np.ndarray, k: int) -> list[int]:
    """Places of the ``k`` best of ``keep``: highest score, then smallest id."""
    if len(keep) > 4 * k and scores.dtype != object:
        own = scores[keep]
        keep = keep[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return sorted(keep.tolist(), key=lambda i: (-int(scores[i]), int(ids[i]), i))[:k]


def order_text(score: int) -> str:
    """A text that sorts as the score does, whatever its size."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):04}{digits}"
    return f"0{9999 - len(digits):04}" + digits.translate(str.maketrans("0123456789", "9876543210"))


POSITIVES = "a_row long, anchor_id long, row long, id long, score string, place string"
NEGATIVES = "a_row long, anchor_id long, p_row long, positive_id long, positive_score string, row long, id long, score string, place string"


def _table(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _positives(k: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            scorer = Scorer(_matrix(rows["v"]), _matrix(anchors["v"]))
            own, label, ids = (rows[c].to_numpy() for c in ("row", "label", "id"))
            for i, a in enumerate(anchors.itertuples(index=False)):
                scores = scorer.scores(i)
                for j in _best(scores, ids, np.flatnonzero((label == a.label) & (own != a.row)), k):
                    out.append((a.row, a.id, own[j], ids[j], str(scores[j]), order_text(int(scores[j]))))
        return _table(out, POSITIVES)
    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(anchors):
            scorer = Scorer(_matrix(rows["v"]), _matrix(anchors["v"]))
            own, label, ids = (rows[c].to_numpy() for c in ("row", "label", "id"))
            for i, a in enumerate(anchors.itertuples(index=False)):
                scores = scorer.scores(i)
                others = np.flatnonzero(label != a.label)
                s = scores[others]
                for p_row, p_id, p_score in zip(a.p_rows, a.p_ids, a.p_scores, strict=True):
                    least, most = -(-low * int(p_score) // 100), high * int(p_score) // 100  # whole numbers within the range
                    for j in _best(scores, ids, others[(s >= least) & (s <= most)], k):
                        out.append((a.row, a.id, p_row, p_id, p_score, own[j], ids[j], str(scores[j]), order_text(int(scores[j]))))
        return _table(out, NEGATIVES)
    return run


def _ranked(df: DataFrame, group: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each group, with their ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.col("place").desc(), "id", "row")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def prepared(vectors: DataFrame) -> DataFrame:
    """Stored rows (row, id, label, v) of ``vectors`` (id, label, vector) that take part."""
    used = vectors.filter(usable(F.col("vector"), F.col("label")))
    return cut(used.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"),
                           F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("v")), "vectors")


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``prepared`` rows.

    Anchors are rows whose id is divisible by ``every``; a negative's score is within ``low``
    and ``high`` hundredths of the positive's.
    """
    asks = (F.col("id") != NO_ID) & (F.col("id") % every == 0)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(asks).alias("anchors")).first()
    n_parts, n_slices = 1 + counts["n"] // PART_ROWS, 1 + counts["anchors"] // ANCHOR_ROWS
    dealt = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    anchors = rows.filter(asks).select(*[F.col(c).alias(c) for c in rows.columns]).withColumn("slice", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_slices)).cast("int"))

    # an anchor meets the parts of its label's bucket
    bucket = F.pmod(F.xxhash64("label"), F.lit(n_parts)).cast("int")
    sizes = cut(rows.groupBy(bucket.alias("bucket")).agg(F.ceil(F.count("*") / F.lit(PART_ROWS)).cast("int").alias("parts")), "sizes")
    alike = (dealt.withColumn("bucket", bucket).join(sizes, "bucket")
             .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts"))
    own = (anchors.withColumn("bucket", bucket).join(sizes, "bucket")
           .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
    keys = ["bucket", "part", "slice"]
    met = alike.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(_positives(positives), POSITIVES)
    chosen = cut(_ranked(met, ["a_row"], positives).groupBy(F.col("a_row").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "row", "id", "score"))).alias("p")), "positives")

    # and then all parts
    sent = (anchors.join(chosen, "row").select("row", "id", "label", "v", "slice", *[F.col(f"p.{c}").alias(f"p_{c}s") for c in ("row", "id", "score")])
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))))
    every_one = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_parts)).cast("int"))
    keys = ["part", "slice"]
    met = every_one.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(_negatives(negatives, low, high), NEGATIVES)

    def number(c):  # beyond 64 bits the nearest 64-bit value
        return F.coalesce(F.col(c).try_cast("long"), F.when(F.col(c).startswith("-"), F.lit(LEAST)).otherwise(F.lit(MOST)))

    def named(c):
        return F.when(F.col(c) != NO_ID, F.col(c))

    return _ranked(met, ["a_row", "p_row"], negatives).select(
        "anchor_id", named("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), named("id").alias("negative_id"),
        number("positive_score").alias("positive_score"), number("score").alias("negative_score"))
