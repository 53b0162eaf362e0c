"""Removal of word windows that an earlier document holds too, found by difference-cover anchors.

Two occurrences of one passage may stand at any two offsets.  A difference cover ``D``
modulo ``PERIOD`` holds, for every difference, two members that differ by it, so some shift
below ``PERIOD`` brings both occurrences to positions whose remainders are in ``D``.  So only
windows of ``window - PERIOD + 1`` words at such positions (the anchors, 3 of 7) are hashed and
exchanged: any common passage of ``window`` words shares an aligned anchor.  Where another
document has an anchor too, it is extended to the windows of full length around it; these are
hashed with 128 bits and exchanged with the smallest document id.  A window whose words stand in
a document with a smaller id is removed.

How it runs.  Texts are stored once in blocks of about a megabyte, bucketed by the task that wrote
them, and never shuffled.  A block sends its distinct hashes, sorted and packed, to ranges of
the hash (``_deal``); each range says with one bit for each hash whether it is found elsewhere;
the bits go back to the block, which finds its hashes again from its own text.  A
block sends a hash once however often it occurs, so a passage that stands in a third of all documents
costs one entry for each block.  Whole texts are exchanged first in the same way, so that of
equal texts only the first takes part further on.

Defined results: a null text has no words; rows without an id remove nothing and lose nothing;
rows of one id do not remove each other's words; equal rows give equal results; an empty table
gives an empty result; other columns are ignored.  A task holds one block: a document
longer than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import BATCH_ROWS, bounded_batches, cut

WINDOW = 13
PERIOD = 7
#: Bytes and rows of a block of texts.
BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
#: Bytes of hashes that one range gets, about.
RANGE_BYTES = 4 << 20
#: Words of more bytes are hashed one by one, all others together, so many bytes at a time.
LONG_WORD = 64
PIECE = 1 << 18
BLANKS = (9, 10, 11, 12, 13, 32)

_rng = np.random.default_rng(12)
_LETTERS = _rng.integers(0, 1 << 63, 256, np.uint64) << np.uint64(1) | np.uint64(1)
_STEP = int(_rng.integers(0, 1 << 62)) * 4 + 3
_FACTORS = _rng.integers(0, 1 << 63, (3, 64), np.uint64) << np.uint64(1) | np.uint64(1)
_BLANK = np.isin(np.arange(256), BLANKS)


def difference_cover(period: int) -> list[int]:
    """Remainders such that every difference modulo ``period`` is one of two of them."""
    cover, missing = [0], set(range(1, period))
    while missing:
        def gains(x):
            return missing & {(s * (x - y)) % period for y in cover for s in (1, -1)}
        best = max(range(period), key=lambda x: (len(gains(x)), -x))
        missing -= gains(best)
        cover.append(best)
    return sorted(cover)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Byte spans and hashes of the words of a block, all at once."""

    def __init__(self):
        self.power = np.cumprod(np.full(PIECE, _STEP, np.uint64))
        self.inverse = np.cumprod(np.full(PIECE, pow(_STEP, -1, 1 << 64), np.uint64))

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(text, np.uint8)
        edge = np.diff((~_BLANK[raw]).view(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out, at = np.empty(len(start), np.uint64), 0
        while at < len(start):
            base = start[at]
            upto = max(at + 1, int(np.searchsorted(end, base + PIECE, "right")))
            n = int(end[upto - 1] - base)
            if n <= PIECE:  # a longer one is a single long word
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(_LETTERS[raw[base:base + n]] * self.power[:n], out=sums[1:])
                s, e = start[at:upto] - base, end[at:upto] - base
                out[at:upto] = (sums[e] - sums[s]) * self.inverse[s]
            at = upto
        for i in np.flatnonzero(end - start > LONG_WORD).tolist():
            out[i] = xxhash.xxh64_intdigest(text[start[i]:end[i]])
        return start, end, mixed(out)


def windows(words: np.ndarray, at: np.ndarray, size: int, which: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on."""
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += words[at + k] * _FACTORS[which][k]
    return mixed(total)


def firsts(key: np.ndarray, more: np.ndarray, doc: np.ndarray):
    """Group of each entry, and the groups' keys, ascending, with their smallest document."""
    order = np.lexsort((doc, more, key))
    k, m = key[order], more[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, k[new], m[new], doc[order][new]


def _range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


SENT = "range int, part int, block int, keys binary, more binary, docs binary"
BITS = "part int, block int, range int, bits binary"


def _deal(part: int, block: int, ranges: int, key: np.ndarray, *others: np.ndarray) -> list[tuple]:
    """Rows of ``SENT``: the ascending keys, and what goes with them, cut by range of the key."""
    of = _range_of(key, ranges)
    cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else []
    return [(int(of[lo]), part, block, key[lo:hi].tobytes(), *[o[lo:hi].tobytes() for o in others], *[b""] * (2 - len(others)))
            for lo, hi in zip(cuts, cuts[1:])]


def _marks(key: np.ndarray, ranges: int, bits: list[dict]) -> np.ndarray:
    """The bits that came back, for each of the keys that were sent."""
    out, of = np.zeros(len(key), bool), _range_of(key, ranges)
    for row in bits:
        lo, hi = np.searchsorted(of, np.uint64(row["range"]), "left"), np.searchsorted(of, np.uint64(row["range"]), "right")
        if (hi - lo + 7) // 8 != len(row["bits"]):
            raise ValueError("the bits of a range do not fit the block's hashes")
        out[lo:hi] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=hi - lo)
    return out


def _answer(pdf: pd.DataFrame, marks: np.ndarray, sizes: list[int]) -> pd.DataFrame:
    rows, at = [], 0
    for part, block, of, n in zip(pdf["part"], pdf["block"], pdf["range"], sizes, strict=True):
        if marks[at:at + n].any():
            rows.append((part, block, of, np.packbits(marks[at:at + n]).tobytes()))
        at += n
    return pd.DataFrame(rows, columns=["part", "block", "range", "bits"])


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Marks the hashes that more than one block sent."""
    each = [np.frombuffer(x, np.uint64) for x in pdf["keys"]]
    keys = np.concatenate(each)
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    at = np.minimum(np.searchsorted(twice, keys), max(len(twice) - 1, 0))
    return _answer(pdf, twice[at] == keys if len(twice) else np.zeros(len(keys), bool), [len(x) for x in each])


def _earlier(pdf: pd.DataFrame) -> pd.DataFrame:
    """Marks the entries whose key was sent with a smaller document too."""
    each = [np.frombuffer(x, np.uint64) for x in pdf["keys"]]
    doc = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["docs"]])
    group, _, _, least = firsts(np.concatenate(each), np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["more"]]), doc)
    return _answer(pdf, doc > least[group], [len(x) for x in each])


class Finder:
    """What a block finds from its own text and the bits that came back, step by step."""

    def __init__(self, ranges: dict[str, int], window: int, period: int):
        self.ranges, self.window, self.period = ranges, window, period
        self.anchor = window - period + 1
        self.covered = np.isin(np.arange(period), difference_cover(period))
        self.words = Words()

    def texts(self, row: dict):
        """Groups of equal texts among the rows with an id: (rows, group, keys, more, first document)."""
        known = np.array([d is not None for d in row["docs"]], bool)
        docs = np.array([0 if d is None else d for d in row["docs"]], np.int64)
        at = np.flatnonzero(known)
        k1, k2 = (np.array(row[c], np.int64).view(np.uint64)[at] for c in ("k1", "k2"))
        return docs, known, at, *firsts(k1, k2, docs[at])

    def open(self, row: dict, bits: dict[str, list]) -> None:
        """Words of the block, and which rows still take part."""
        self.docs, known, at, group, keys, _, least = self.texts(row)
        later = (self.docs[at] > least[group]) | _marks(keys, self.ranges["texts"], bits["texts"])[group]
        self.copies = np.zeros(len(self.docs), bool)
        self.copies[at] = later
        text_start = np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64) + 1)[:-1])).astype(np.int64)
        start, _, self.hashes = self.words.of(row["text"])
        self.row_of = np.searchsorted(text_start, start, "right") - 1
        self.n_words = np.bincount(self.row_of, minlength=len(self.docs))
        first = np.concatenate(([0], np.cumsum(self.n_words)[:-1])).astype(np.int64)
        self.place = np.arange(len(start)) - first[self.row_of]
        self.active = (known & ~self.copies & (self.n_words >= self.window))[self.row_of]
        self.left = self.n_words[self.row_of] - self.place  # words from here to the text's end

    def anchors(self):
        """(places, group of each, keys, whether two rows of the block have it)."""
        at = np.flatnonzero(self.active & self.covered[self.place % self.period] & (self.left >= self.anchor))
        h = windows(self.hashes, at, self.anchor, 0)
        order = np.argsort(h, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        rows = self.row_of[at[order]]
        end = np.append(begin[1:], len(order)) - 1
        return at, group, h[order][new], rows[begin] != rows[end] if len(begin) else np.zeros(0, bool)

    def candidates(self, bits: dict[str, list]):
        """(places, group of each, keys, more, first document) of the windows around anchors that occur elsewhere."""
        at, group, keys, here = self.anchors()
        again = here | _marks(keys, self.ranges["anchors"], bits["anchors"])
        found = np.zeros(len(self.hashes) + 1, np.int64)
        found[at[again[group]] + 1] = 1
        before = np.cumsum(found)
        start = np.flatnonzero(self.active & (self.left >= self.window))
        start = start[before[start + self.period] > before[start]]
        w1, w2 = (windows(self.hashes, start, self.window, k) for k in (1, 2))
        return start, *firsts(w1, w2, self.docs[self.row_of[start]])

    def removed(self, bits: dict[str, list]) -> np.ndarray:
        """Whether each word of the block goes."""
        start, group, keys, _, least = self.candidates(bits)
        gone = (self.docs[self.row_of[start]] > least[group]) | _marks(keys, self.ranges["windows"], bits["windows"])[group]
        steps = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(steps, start[gone], 1)
        np.add.at(steps, start[gone] + self.window, -1)
        return (np.cumsum(steps)[:-1] > 0) | (self.copies & (self.n_words >= self.window))[self.row_of]


def stored_blocks(docs: DataFrame) -> DataFrame:
    """Texts in blocks, one file for each task that reads ``docs``, bucketed by that task."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
    bounded_batches(spark)

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def rows():
            keys = np.array([divmod(xxhash.xxh128_intdigest(t), 1 << 64) for _, t in held], np.uint64).view(np.int64)
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([[d for d, _ in held]], longs),
                 pa.array([[len(t) for _, t in held]], longs), pa.array([keys[:, 0]], longs), pa.array([keys[:, 1]], longs),
                 pa.array([b"\n".join([t for _, t in held])], pa.binary())], ["part", "block", "docs", "sizes", "k1", "k2", "text"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or b""
                if held and (size + len(text) > BLOCK_BYTES or len(held) >= BLOCK_ROWS):
                    yield rows()
                    number, held, size = number + 1, [], 0
                held.append((doc, text))
                size += len(text) + 1
        if held:
            yield rows()

    blocks = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(
        run, "part int, block int, docs array<long>, sizes array<long>, k1 array<long>, k2 array<long>, text binary")
    name = f"blocks_{uuid.uuid4().hex}"
    (blocks.write.option("path", path).option("parquet.block.size", str(8 * BLOCK_BYTES))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").saveAsTable(name))
    stored = spark.table(name)
    stored.schema  # resolved: the files stay when the catalogue forgets them
    spark.sql(f"DROP TABLE {name}")
    return stored


def _answers(blocks: DataFrame, answers: dict[str, DataFrame]) -> DataFrame:
    """``blocks`` with the bits that came back to each; the blocks themselves stay where they are."""
    if not answers:
        return blocks.withColumn("bits", F.array().cast("array<struct<step:string,range:int,bits:binary>>"))
    rows = None
    for step, df in answers.items():
        own = df.withColumn("step", F.lit(step))
        rows = own if rows is None else rows.unionByName(own)
    by_part = rows.groupBy("part").agg(F.collect_list(F.struct("block", "step", "range", "bits")).alias("all"))
    return (blocks.join(by_part.hint("shuffle_hash"), "part", "left")
            .withColumn("bits", F.expr("transform(filter(coalesce(all, array()), x -> x.block = block), x -> struct(x.step, x.range, x.bits))"))
            .drop("all"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row; ``kept``: the words that stay, joined by blanks, as UTF-8 bytes."""
    return _run(docs, window, period, "kept binary", lambda text: text)


def digest(docs: DataFrame, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    return _run(docs, window, period, "kept_sha256 string", lambda text: hashlib.sha256(text).hexdigest())


def _run(docs: DataFrame, window: int, period: int, result: str, of) -> DataFrame:
    spark = docs.sparkSession
    blocks = stored_blocks(docs)
    total = blocks.select(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("n")).agg(F.sum("n")).first()[0] or 0
    # a text has about a word for 6 bytes; 3 of 7 of them begin an anchor of 8 bytes, at most each a window of 24
    ranges = {"texts": 8 + total // (64 * RANGE_BYTES), "anchors": 8 + total // (2 * RANGE_BYTES), "windows": 8 + total // RANGE_BYTES}
    names = [result.split()[0], result.split()[1]]

    def rows_of(batches):
        for b in batches:
            for row in b.to_pylist():
                bits = {step: [x for x in row["bits"] if x["step"] == step] for step in ranges}
                yield row, bits

    def sender(step):
        def run(batches):
            finder = Finder(ranges, window, period)
            for row, bits in rows_of(batches):
                if step == "texts":
                    *_, keys, more, least = finder.texts(row)
                    sent = _deal(row["part"], row["block"], ranges[step], keys, more, least)
                else:
                    finder.open(row, bits)
                    if step == "anchors":
                        sent = _deal(row["part"], row["block"], ranges[step], finder.anchors()[2])
                    else:
                        _, _, keys, more, least = finder.candidates(bits)
                        sent = _deal(row["part"], row["block"], ranges[step], keys, more, least)
                if sent:
                    kinds = [pa.int32()] * 3 + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent, strict=True), kinds, strict=True)],
                                                     [x.split()[0] for x in SENT.split(", ")])
        return run

    def finish(batches):
        finder = Finder(ranges, window, period)
        kind = pa.string() if names[1] == "string" else pa.binary()
        for row, bits in rows_of(batches):
            finder.open(row, bits)
            gone = finder.removed(bits)
            n_gone = np.bincount(finder.row_of[gone], minlength=len(finder.docs))
            ends = np.concatenate(([0], np.cumsum(finder.n_words)))
            kept, at = [], 0
            for i, size in enumerate(row["sizes"]):
                words = row["text"][at:at + size].split()
                at += size + 1
                if n_gone[i]:
                    words = compress(words, (~gone[ends[i]:ends[i + 1]]).tolist())
                kept.append(of(b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["docs"], pa.int64()), pa.array(finder.n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, kind)],
                ["doc_id", "n_words", "n_removed", names[0]])

    answers: dict[str, DataFrame] = {}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a row is a whole block
    try:
        for step, judge in (("texts", _earlier), ("anchors", _repeated), ("windows", _earlier)):
            needed = blocks.select("part", "block", "docs", "k1", "k2") if step == "texts" else blocks
            sent = _answers(needed, answers).mapInArrow(sender(step), SENT)
            answers[step] = cut(sent.groupBy("range").applyInPandas(judge, BITS), step)
        return cut(_answers(blocks, answers).mapInArrow(finish, f"doc_id long, n_words long, n_removed long, {result}"), "kept")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
