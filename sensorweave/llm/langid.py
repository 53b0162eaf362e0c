"""Language identification with bit-sliced Bloom filters over character n-grams.

One table of slots serves all languages: a slot holds a bitmask with one bit for
each language.  An n-gram sets its languages' bits in several slots; the AND over
its slots returns every language that contains it.  A text is decided by its
per-language popcounts, in which an n-gram counts the more the fewer languages contain it,
corrected for the share of n-grams that would hit a language's slice by chance.

A language contains every n-gram that its learning documents have ``least`` times (3), however
rare; only one that another language has ``stray`` times (1000) as often, share by share, is
taken for a stray of that language.  The n-gram counts cover the whole text of every learning
document and are summed before the shuffle.  What is collected is the slot table alone:
it has about two slots for each hash of an n-gram, at most ``2**MAX_BITS``, and
``MAX_LANGUAGES`` bounds its width.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties
go to the language with more learning n-grams, then by name; rows without a text or
a language teach nothing; with no learned language everything is ``und``; repeated
rows and null ids are predicted like any others; other columns are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, cut, map_batches

UNKNOWN = "und"
MAX_LANGUAGES = 512
#: The slot table has 2**16 to 2**23 slots (8 bytes each for up to 64 languages).
MIN_BITS, MAX_BITS = 16, 23
#: Code points handled at once.
_SLICE = 1 << 18
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    """Rows whose remainder is known not to be 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


_LETTER: list = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[str | None]):
    """(trigram codes, index of each one's text) of slices of the texts.

    Lower-cased; every run of other characters counts as a blank; a trigram has a
    letter in its middle.  A text over the slice size comes in overlapping parts.
    """
    parts, size = [], 0
    for i, text in enumerate(texts):
        low = f" {(text or '').lower()} "
        for at in range(0, len(low) - 2, _SLICE):
            part = low[at:at + _SLICE + 2]
            parts.append((i, part))
            size += len(part)
            if size >= _SLICE:
                yield _codes(parts)
                parts, size = [], 0
    if parts:
        yield _codes(parts)


def _codes(parts: list[tuple[int, str]]):
    points = np.frombuffer("".join(p for _, p in parts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    lengths = [len(p) for _, p in parts]
    letter = letters()[points]
    points = np.where(letter, points, 32)
    own = np.repeat(np.array([i for i, _ in parts]), lengths)
    ok = letter[1:-1].copy()
    ok &= own[2:] == own[:-2]
    edges = np.cumsum(lengths)[:-1]  # no trigram across two parts of one text: they overlap
    for e in (edges - 1, edges - 2):
        ok[e[e < len(ok)]] = False
    at = np.flatnonzero(ok)
    return (points[at] << 42) | (points[at + 1] << 21) | points[at + 2], own[at]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over the whole texts of ``docs`` (lang, text)."""
    def run(batches):
        seen: dict[str, dict[int, int]] = {}
        held = 0
        for b in batches:
            langs = b.column(0).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            for codes, own in grams(b.column(1).to_pylist()):
                for k, lang in enumerate(names):
                    values, n = np.unique(codes[number[own] == k], return_counts=True)
                    mine = seen.setdefault(lang, {})
                    held -= len(mine)
                    for v, c in zip(values.tolist(), n.tolist(), strict=True):
                        mine[v] = mine.get(v, 0) + c
                    held += len(mine)
            if held > 1_000_000:
                yield from _counted(seen)
                seen, held = {}, 0
        yield from _counted(seen)

    return (map_batches(docs, ["lang", "text"], "lang string, gram long, n long", run)
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _counted(seen: dict[str, dict[int, int]]):
    for lang, counts in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "gram", "n"])


def slots_of(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The slots of each code, one array for each hash."""
    u = codes.astype(np.uint64)
    out = []
    for m in _MIX:
        h = u * np.uint64(m)
        h ^= h >> np.uint64(29)
        out.append(((h * np.uint64(_MIX[0])) >> np.uint64(64 - bits)).astype(np.int64))
    return out


@dataclass
class Filters:
    """The slot table: ``table[word, slot]``; bit l % 64 of word l // 64 belongs to ``languages[l]``."""
    languages: list[str]
    bits: int
    table: np.ndarray
    chance: np.ndarray = field(init=False)

    def __post_init__(self):
        fill = [((self.table[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(self.languages))]
        self.chance = np.minimum(np.array(fill) ** len(_MIX), 0.999)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        hits, total = np.zeros((len(self.languages), len(texts))), np.zeros(len(texts))
        weight = weights(len(self.languages))
        for codes, own in grams(texts):
            slots = slots_of(codes, self.bits)
            masks = [table[slots[0]] & table[slots[1]] & table[slots[2]] for table in self.table]
            counts = weight[sum(np.bitwise_count(m).astype(np.int64) for m in masks)]
            edge = np.searchsorted(own, np.arange(len(texts) + 1))

            def by_text(values, edge=edge):
                upto = np.concatenate(([0.0], np.cumsum(values)))
                return upto[edge[1:]] - upto[edge[:-1]]

            total += by_text(counts)
            for k in range(len(self.languages)):
                hits[k] += by_text(counts * ((masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)))
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        share = np.clip((hits / np.where(total > 0, total, 1) - self.chance[:, None]) / (1 - self.chance[:, None]), 0, 1)
        best = share.argmax(axis=0)  # the first of equals
        langs = [self.languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), total.tolist(), strict=True)]
        return langs, np.where(total > 0, share.max(axis=0), 0.0).tolist()


def weights(languages: int) -> np.ndarray:
    """What an n-gram counts that 0, 1, ... of the languages contain."""
    return np.log((languages + 1) / np.maximum(np.arange(languages + 1), 1))


def fit(docs: DataFrame, least: int = 3, stray: float = 1000.0, bits: int | None = None) -> Filters:
    """Filters learned from ``docs`` (text, lang): the n-grams that each language contains; 2**bits slots, by default by their number."""
    known = docs.filter("text is not null and lang is not null").select("lang", "text")
    counts = cut(gram_counts(known), "grams")
    sums = [(r["lang"], r["n"]) for r in
            counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(MAX_LANGUAGES + 1).collect()]
    if len(sums) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [x for x, _ in sorted(sums, key=lambda x: (-x[1], x[0]))]
    if not languages:
        return Filters([], MIN_BITS, np.zeros((1, 1 << MIN_BITS), np.uint64))
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)])
    size = F.create_map(*[F.lit(x) for lang, n in sums for x in (lang, float(n))])
    shares = counts.select("gram", "n", number[F.col("lang")].alias("k"), (F.col("n") / size[F.col("lang")]).alias("p"))
    most = shares.groupBy("gram").agg(F.max("p").alias("most"))
    own = cut(shares.join(most, "gram").filter((F.col("n") >= least) & (stray * F.col("p") >= F.col("most"))).select("gram", "k"), "filters")
    if bits is None:
        distinct = own.select("gram").distinct().count()
        bits = min(max((2 * len(_MIX) * distinct).bit_length(), MIN_BITS), MAX_BITS)
    table = np.zeros((-(-len(languages) // 64), 1 << bits), np.uint64)

    def place(batches):
        for b in batches:
            slots = slots_of(b.column(0).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(slots)), pa.array(np.tile(b.column(1).to_numpy(), len(slots)))], ["slot", "k"])

    masks = (own.mapInArrow(place, "slot long, k int")
             .select("slot", F.floor(F.col("k") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, k % 64)").alias("m"))
             .groupBy("w", "slot").agg(F.bit_or("m").alias("m")))
    found = masks.toPandas()
    table[found["w"].to_numpy(), found["slot"].to_numpy()] = found["m"].to_numpy().astype(np.int64).view(np.uint64)
    return Filters(languages, bits, table)


def identify(docs: DataFrame, filters: Filters, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and the corrected share of n-grams that it contains."""
    shared, held = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.bits, filters.table)), []

    def predict(texts):
        if not held:
            held.append(Filters(*shared.value))
        return held[0].predict(texts)

    return append_columns(docs, {"text": F.col("text").cast("string")}, f"{lang} string, {score} double", predict)
