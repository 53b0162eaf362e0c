"""Personal data: patterns, and terms that disclose the entities they found.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  Hiding those
is not enough where other words give them away, so corpus co-occurrence estimates how
strongly a term reveals an entity: of n distinct texts in all, n_e hold the entity, n_t the
term, and n_et the term within ``CONTEXT_WORDS`` words of the entity, whatever the lines,

    disclosure = PMI(e, t) / IC(e) = 1 - log(n_t / n_et) / log(n / n_e)

is the share of the entity's information that the term carries.  A term at or above
``generalise`` is generalised at all its places in every text that holds the entity, one
at or above ``remove`` is removed there.  All counts are of distinct texts: copies of a whole text are one observation,
a line that different texts share counts in each.  Pairs seen in fewer than ``support``
texts prove nothing; the default of two asks only that one text is not the whole evidence.

Two passes over all texts: the first finds the patterns and, in texts with an entity, the
terms beside it; the second counts candidate terms over the whole corpus.  A last pass over
the texts with an entity finds all places of proven terms.  Candidates and proven terms
reach a pass as a bitmap sized by their number, up to 8 MB; whatever else passes the bitmap is dropped by the
exact join that follows.  n_t is exact: texts that stand once are counted as
they are read, repeated ones by a distinct count.

Defined results: a null or empty text has no spans; repeated rows get the same spans;
null ids are kept; an empty table gives an empty result; other columns are passed
through by ``sanitise``.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, bitmap, cut, map_batches

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
CONTEXT_WORDS = 32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\S+")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¿¡"


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the local part is all that stands before an ``@``, down to the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(done, at + 1))
    return out


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), ordered by kind and start."""
    out = [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> int:
    """64-bit id of an entity: the same number or address in any spelling."""
    plain = value.lower() if kind == "email" else _NOT_DIGIT.sub("" if kind != "ip" else ".", value)
    return _signed(f"{kind}:{plain}")


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def term(word: str) -> int | None:
    """64-bit id of a word without its punctuation, or None if nothing is left of it."""
    plain = word.strip(_EDGE).lower()
    return _signed(plain) if plain else None


def words_outside(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[str | None]]:
    """(start, end) of each word of a text, and the word, or None where it touches a span."""
    order, i, upto, places, words = sorted(spans), 0, 0, [], []
    for m in _WORD.finditer(text):
        s, e = m.span()
        while i < len(order) and order[i][0] < e:
            upto = max(upto, order[i][1])
            i += 1
        places.append((s, e))
        words.append(m.group() if upto <= s else None)
    return places, words


def beside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(entity, term) of each term within ``CONTEXT_WORDS`` words of a span, each pair once."""
    if not spans:
        return []
    places, words = words_outside(text, [(s, e) for _, s, e in spans])
    starts, ends, terms, out = [s for s, _ in places], [e for _, e in places], {}, set()
    for kind, s, e in spans:
        x, lo, hi = entity(kind, text[s:e]), bisect_right(ends, s), bisect_left(starts, e)
        for k in range(max(lo - CONTEXT_WORDS, 0), min(hi + CONTEXT_WORDS, len(words))):
            if words[k] is not None:
                if k not in terms:
                    terms[k] = term(words[k])
                if terms[k] is not None:
                    out.add((x, terms[k]))
    return sorted(out)


def first_pass(docs: DataFrame) -> DataFrame:
    """(row, doc_id, hash, spans, entities, beside, text) of each row; ``row`` is its place in the scan.

    The text is kept only where it has spans.
    """
    schema = ("row long, doc_id long, hash long, spans array<struct<kind: string, start: long, end: long>>, "
              "entities array<long>, beside array<struct<e: long, t: long>>, text string")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    pair = pa.struct([(c, pa.int64()) for c in ("e", "t")])

    def run(batches):
        for b in batches:
            spans, held, near, texts = [], [], [], []
            for text in b.column(3).to_pylist():
                text = text or ""
                found = base_spans(text)
                spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in found])
                held.append(sorted({entity(kind, text[s:e]) for kind, s, e in found}))
                near.append([{"e": e, "t": t} for e, t in beside(text, found)])
                texts.append(text if found else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(spans, pa.list_(span)), pa.array(held, pa.list_(pa.int64())),
                 pa.array(near, pa.list_(pair)), pa.array(texts, pa.string())],
                ["row", "doc_id", "hash", "spans", "entities", "beside", "text"])

    return map_batches(docs, [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                              F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text")], schema, run)


def _bitmap(df: DataFrame, key: str):
    """The bitmap of the distinct ``key`` of ``df``, broadcast."""
    return df.sparkSession.sparkContext.broadcast(bitmap(df, key))


def _holds(held: tuple[int, np.ndarray], key: int) -> int:
    bits, words = held
    at = key & ((1 << bits) - 1)
    return int(words[at >> 6]) >> (at & 63) & 1


def term_counts(docs: DataFrame, candidates: DataFrame, repeated: DataFrame) -> DataFrame:
    """(t, n_t): distinct texts of the corpus with each candidate term ``t`` (and some others).

    ``repeated``: the ``hash`` of each text that stands more than once.
    """
    shared, copied = _bitmap(candidates, "t"), _bitmap(repeated, "hash")
    schema = pa.schema([(c, pa.int64()) for c in ("t", "h", "n")])

    def run(batches):
        cache: dict[str, int | None] = {}
        once: dict[int, int] = {}
        seen: set[int] = set()
        for b in batches:
            ts, hs = [], []
            for text, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                copy = _holds(copied.value, h)
                if copy and h in seen:
                    continue
                hits = set()
                for w in set((text or "").split()):
                    if w not in cache:
                        if len(cache) > 300_000:
                            cache.clear()
                        cache[w] = _candidate(w, shared.value)
                    if cache[w] is not None:
                        hits.add(cache[w])
                if copy:
                    if len(seen) > 300_000:
                        seen.clear()
                    seen.add(h)
                    ts += hits
                    hs += [h] * len(hits)
                else:
                    for t in hits:
                        once[t] = once.get(t, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(ts, pa.int64()), pa.array(hs, pa.int64()), pa.array([1] * len(ts), pa.int64())], schema=schema)
            if len(once) > 100_000:
                yield _counts(once, schema)
                once = {}
        yield _counts(once, schema)

    rows = map_batches(docs, [F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h")], "t long, h long, n long", run)
    each = rows.groupBy("t", "h").agg(F.sum("n").alias("n"))
    return each.groupBy("t").agg(F.sum(F.when(F.col("h").isNull(), F.col("n")).otherwise(1)).alias("n_t"))


def _counts(once: dict[int, int], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(once), pa.int64()), pa.nulls(len(once), pa.int64()),
                                       pa.array(list(once.values()), pa.int64())], schema=schema)


def _candidate(word: str, held: tuple[int, np.ndarray]) -> int | None:
    t = term(word)
    return t if t is not None and _holds(held, t) else None


def term_places(held: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, t, places): all places of each term ``t`` (and of some others) outside the spans of rows (row, text, spans)."""
    schema, place = "row long, t long, places array<struct<start: long, end: long>>", ("start", "end")
    shared = _bitmap(terms, "t")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in place]))

    def run(batches):
        cache: dict[str, int | None] = {}
        for b in batches:
            rows, ts, at = [], [], []
            for row, text, spans in zip(*[b.column(k).to_pylist() for k in range(3)], strict=True):
                found: dict[int, list] = {}
                for (s, _), w in zip(*words_outside(text, [(x["start"], x["end"]) for x in spans]), strict=True):
                    if w is None:
                        continue
                    if w not in cache:
                        if len(cache) > 300_000:
                            cache.clear()
                        cache[w] = _candidate(w, shared.value)
                    if cache[w] is not None:
                        lead = s + len(w) - len(w.lstrip(_EDGE))
                        found.setdefault(cache[w], []).append({"start": lead, "end": lead + len(w.strip(_EDGE))})
                rows += [row] * len(found)
                ts += found
                at += found.values()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ts, pa.int64()), pa.array(at, kind)],
                                             ["row", "t", "places"])

    return map_batches(held, ["row", "text", "spans"], schema, run)


def disclosing(found: DataFrame, docs: DataFrame, support: int, generalise: float, remove: float) -> DataFrame:
    """(row, start, end, removed): the terms to hide in each row; ``found`` is the stored first pass."""
    near = found.select("hash", F.explode("beside").alias("b")).select("hash", "b.*")
    texts = cut(found.groupBy("hash").agg(F.count("*").alias("times")), "texts")
    n = texts.count()
    seen = (near.select("e", "t", "hash").distinct().groupBy("e", "t").agg(F.count("*").alias("n_et"))
            .filter(F.col("n_et") >= support))
    n_e = found.select("hash", F.explode("entities").alias("e")).distinct().groupBy("e").agg(F.count("*").alias("n_e"))
    seen = cut(seen.join(n_e, "e"), "cooccurrence")
    counts = term_counts(docs, seen.select("t").distinct(), texts.filter("times > 1"))
    share = 1 - F.log(F.greatest("n_t", "n_et") / F.col("n_et")) / F.log(F.lit(float(max(n, 2))) / F.col("n_e"))
    strong = (seen.join(counts, "t").filter(F.col("n_e") < n).select("e", "t", share.alias("share"))
              .filter(F.col("share") >= generalise).select("e", "t", (F.col("share") >= remove).alias("removed")))
    strong = cut(strong, "disclosing")
    places = term_places(found.filter(F.size("spans") > 0), strong.select("t").distinct())
    # a term is strong only for entities that most of its texts hold, so this join stays near the pairs that exist
    held = found.select("row", F.explode("entities").alias("e"))
    return (places.join(strong, "t").join(held, ["row", "e"]).select("row", "removed", F.explode("places").alias("p"))
            .groupBy("row", F.col("p.start").alias("start"), F.col("p.end").alias("end")).agg(F.max("removed").alias("removed")))


def find(docs: DataFrame, support: int = 2, generalise: float = 0.85, remove: float = 0.95) -> DataFrame:
    """(row, doc_id, spans, terms) of each row: pattern spans, and (start, end, removed) of disclosing terms."""
    found = cut(first_pass(docs), "spans")
    terms = (disclosing(found, docs, support, generalise, remove).groupBy(F.col("row").alias("t_row"))
             .agg(F.array_sort(F.collect_list(F.struct("start", "end", "removed"))).alias("terms")))
    empty = F.array().cast("array<struct<start: long, end: long, removed: boolean>>")
    return (found.drop("beside", "entities", "hash", "text").join(terms, F.col("row") == F.col("t_row"), "left").drop("t_row")
            .withColumn("terms", F.coalesce("terms", empty)))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, base_sha256 and spans of the rows of ``find``."""
    def joined(spans, kind=None):
        return F.transform(spans, lambda x: F.concat_ws(
            ":", F.lit(kind) if kind else x["kind"], x["start"].cast("string"), x["end"].cast("string")))

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = joined(F.col("spans"))
    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, joined(F.col("terms"), TERM)), ",").alias("spans"))


def hidden(text: str | None, spans: list | None, terms: list | None) -> str | None:
    """The text with spans replaced by their kind, generalised terms by ``[term]``, removed ones by nothing."""
    if not text or not (spans or terms):
        return text
    marks = [(x["start"], x["end"], f"[{x['kind']}]") for x in spans or ()]
    marks += [(x["start"], x["end"], "" if x["removed"] else f"[{TERM}]") for x in terms or ()]
    out, at = [], 0
    for start, end, mark in sorted(marks):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, support: int = 2, generalise: float = 0.85, remove: float = 0.95) -> DataFrame:
    """``docs`` with sanitised texts.  ``docs`` must be a stored table as read: a row's place in the scan names it."""
    own = docs.columns
    marks = (find(docs, support, generalise, remove).filter((F.size("spans") > 0) | (F.size("terms") > 0))
             .select(F.col("row").alias("__row"), F.col("doc_id").alias("__id"), F.col("spans").alias("__spans"),
                     F.col("terms").alias("__terms")))
    placed = docs.select(*[F.col(f"`{c}`") for c in own], F.monotonically_increasing_id().alias("__place"))
    same = F.when(F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) | F.col("__row").isNull(), F.col("text").cast("string")) \
        .otherwise(F.raise_error(F.lit("the table changed between two passes")))
    joined = placed.join(marks, F.col("__place") == F.col("__row"), "left")
    new = append_columns(joined, {"text": same, "spans": F.col("__spans"), "terms": F.col("__terms")}, "__new string",
                         lambda *cols: [[hidden(*x) for x in zip(*cols, strict=True)]])
    return new.select(*[F.col("__new").alias(c) if c == "text" else F.col(f"`{c}`") for c in own])
