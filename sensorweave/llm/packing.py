"""Best-two-fit packing of tokenised documents into fixed-length sequences.

A bin is filled greedily with the largest document that fits; then its smallest
document is replaced by two unpacked documents that fill the expanded gap more
tightly, as long as that gains anything.  Documents of one length are
interchangeable, so the plan is made on the histogram of lengths, at most
``capacity`` rows whatever the corpus, and each filling is applied to as many bins
as the counts allow.  A document then needs only its rank among those of its
length: its index in its task plus the counts of earlier tasks.  Only a document
longer than ``capacity`` is cut.

Defined results: a null or empty text has no ids but the end id; repeated rows and
null ids are packed like any others; an empty table packs nothing; other columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, sums_before

#: Pieces of each of two generations whose ids a task keeps.
CACHE_WORDS = 300_000


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Kept(dict):
    """A dict in two generations of ``CACHE_WORDS`` entries: what is used again outlives the older one."""

    def __init__(self):
        super().__init__()
        self.older = {}

    def put(self, key, value):
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Pieces(Kept):
    """Ids of the tokenizer's pieces."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = packed([t.id for t in self.model.tokenize("".join([self.letters[b] for b in piece.encode()]))])
        return self.put(piece, ids) if len(piece) < 100 else ids


class TextIds(Kept):
    """Ids, as little-endian uint32 bytes, of a text.

    The tokenizer's pieces never cross white space.  Texts of ASCII and Latin-1 letters, the
    same in every normal form, are split here by the tokenizer's pattern, all at once, and
    looked up piece by piece; of all other texts only the parts between blanks that have other
    characters go through the whole tokenizer.
    """

    plain = re.compile(r"[ -~À-ÖØ-öø-ÿ]*")
    piece = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.pieces = Pieces(self.whole.model)

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = packed(self.whole.encode(part, add_special_tokens=False).ids)
        return self.put(part, ids) if len(part) < 100 else ids

    def simple(self, text: str) -> bool:
        return "<|" not in text and self.plain.fullmatch(text) is not None

    def of(self, text: str) -> bytes:
        text = text.replace("\n", " ")
        if self.simple(text):
            return b"".join(map(self.pieces.__getitem__, self.piece.findall(text.lower())))
        return b"".join([self.of(part) if self.simple(part) else self[part] for part in text.split(" ")])


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, k[, ids]): the pieces of each document.

    ``k``: the piece's index among those of its length in its task ``part``.
    """
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "k", *["ids"] * ids]

    def run(batches):
        words, seen, part = TextIds(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = words.of(text or "") + end
                for n, at in enumerate(range(0, len(raw), step)):
                    own = raw[at:at + step]
                    size = len(own) // 4
                    rows.append((doc, n, at // 4, size, zlib.crc32(own), part, int(seen[size]), own)[:len(names)])
                    seen[size] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=False)]
            if ids:
                arrays.append(pa.array([np.frombuffer(r, "<u4").astype(np.int32) for r in cols[-1]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")],
                       "doc_id long, piece int, start long, length long, ids_crc32 long, part int, k long"
                       + ", ids array<int>" * ids, run)


def fillings(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-two-fit on a histogram: ({length: documents of a bin}, number of such bins)."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    out = []
    while (have := np.flatnonzero(left)).size:
        bin_, gap = {int(have[-1]): 1}, capacity - int(have[-1])
        left[have[-1]] -= 1
        while gap:  # greedily, the largest that fits
            have = np.flatnonzero(left[:gap + 1])
            if not have.size:
                break
            size = int(have[-1])
            n = min(int(left[size]), gap // size)
            bin_[size] = bin_.get(size, 0) + n
            left[size] -= n
            gap -= n * size
        while gap:  # two for the smallest
            small = min(bin_)
            room = gap + small
            have = np.flatnonzero(left[:room])
            if not have.size:
                break
            at = np.searchsorted(have, room - have, "right") - 1
            ok = at >= 0
            second = have[np.maximum(at, 0)]
            alone = ok & (second == have) & (left[have] < 2)  # the same length twice needs two of it
            at = np.where(alone, at - 1, at)
            ok &= at >= 0
            second = have[np.maximum(at, 0)]
            total = np.where(ok, have + second, 0)
            best = int(total.argmax())
            if total[best] <= small:
                break
            two = (int(have[best]), int(second[best]))
            bin_[small] -= 1
            left[small] += 1
            if not bin_[small]:
                del bin_[small]
            for size in two:
                bin_[size] = bin_.get(size, 0) + 1
                left[size] -= 1
            gap = room - sum(two)
        more = min(int(left[size]) // n for size, n in bin_.items())
        for size, n in bin_.items():
            left[size] -= n * more
        out.append((bin_, 1 + more))
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of each piece."""
    cutup = cut(pieces(docs, tokenizer, capacity, end_id, ids), "pieces")
    counts = cutup.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # one row for each length of each filling: from rank `base` on, `n` documents a bin
    rows, taken, first = [], {}, 0
    for bin_, bins in fillings(histogram, capacity):
        place = 0
        for size, n in sorted(bin_.items(), reverse=True):
            base = taken.get(size, 0)
            rows.append((size, base, n, first, place))
            taken[size] = base + n * bins
            place += n * size
        first += bins
    plan = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    keys = (plan[0] << 48) + plan[1]
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def run(batches):
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, (size << 48) + rank, "right") - 1
            inner = rank - plan[1][at]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], pa.array(plan[3][at] + inner // plan[2][at]),
                 pa.array(plan[4][at] + inner % plan[2][at] * size)], [*kept, "sequence_id", "offset"])

    offsets = sums_before(counts, ["length"], "part", "n", "off").drop("n")
    ranked = cutup.join(offsets, ["part", "length"]).select(*kept, (F.col("k") + F.col("off")).alias("rank"))
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                             + "ids array<int>, " * ids + "sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, of ``pack(..., ids=True)``."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(rows, lambda r: r["ids"])).alias("ids"))
