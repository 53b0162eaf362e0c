"""RDF triples as a DataFrame ``(s, p, o)`` and graph-pattern operators over it.

* basic graph patterns are self-joins of the triples frame (one per pattern);
* ``rdf:rest*/rdf:first`` list expansion uses forward pointer jumping: O(log L) join
  rounds for a list of length L;
* maxima over list members are folded along the links by the same jumps, so no list is
  expanded and a tail that many lists share is folded once;
* ``rdfs:subClassOf`` closure uses semi-naive doubling (O(log depth) rounds, each
  composing only the pairs found in the previous round).

Iterative operators cut lineage after every round with a table written under the
shared ``spark.checkpoint.dir``; executors lost mid-way recompute at most one round.
A round's shuffle files go when it is written, and ``settled`` drops the rounds behind a result.
All operators run on a frame of terms or on the ids of a ``TripleStore``.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import OWL, RDF, RDFS, XSD
from ..session import drop_scratch, scratch_path

RDF_TYPE = RDF + "type"
RDF_FIRST = RDF + "first"
RDF_REST = RDF + "rest"
RDF_NIL = RDF + "nil"
SUBCLASS = RDFS + "subClassOf"
OWL_CLASS = OWL + "Class"
OWL_RESTRICTION = OWL + "Restriction"
ON_PROPERTY = OWL + "onProperty"
ALL_VALUES_FROM = OWL + "allValuesFrom"
ON_DATATYPE = OWL + "onDatatype"
WITH_RESTRICTIONS = OWL + "withRestrictions"
MIN_INCL = XSD + "minInclusive"
MAX_INCL = XSD + "maxInclusive"

# N-Triples line: <s> <p> <o> . | _:b <p> "lit"^^<dt> .
_TERM = r'(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]*>|@[A-Za-z-]+)?)'
_LINE = rf"^\s*{_TERM}\s+{_TERM}\s+{_TERM}\s*\.\s*$"


_ESCAPES = (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"'))  # fixed values: text in a literal, character
IRI = r'^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>"{}|^`\\]*$'
_PLAIN_IRI = r"^[A-Za-z][A-Za-z0-9+.-]*+:[!#-;=?-\[\]_a-z~]*+$"  # of the characters that an IRI may hold, those of ASCII
_COMMON = (RDF_NIL, OWL_CLASS, OWL_RESTRICTION, XSD + "float")


def _escaped(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for text, char in _ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(text))
    return out


def _unescaped(c: Column) -> Column:
    # an escaped backslash stands aside as a character that no N-Triples text may hold
    out = F.replace(c, F.lit("\\\\"), F.lit("\0"))
    for text, char in _ESCAPES:
        out = F.replace(out, F.lit(text), F.lit(char))
    return F.replace(out, F.lit("\0"), F.lit("\\"))


def _unterm(c: Column) -> Column:
    """IRI -> bare IRI text, literal -> lexical form (unescaped), blank node as is."""
    iri = F.regexp_extract(c, r"^<(.*)>$", 1)
    lit = _unescaped(F.regexp_extract(c, r'^"((?:[^"\\]|\\.)*)"', 1))
    return F.when(c.startswith("<"), iri).when(c.startswith('"'), lit).otherwise(c)


def _kind(c: Column) -> Column:
    return F.when(c.startswith("<"), F.lit("iri")).when(c.startswith('"'), F.lit("literal")).otherwise(F.lit("blank"))


def _scan(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", *[F.regexp_extract("value", _LINE, i).alias(n) for i, n in ((1, "_s"), (2, "_p"), (3, "_o"))])


def read_ntriples(spark: SparkSession, path: str, kinds: bool = False) -> DataFrame:
    """Line-oriented N-Triples scan -> (s, p, o); comments and blank lines are skipped,
    unparsable ones are in ``ntriples_rejects``.  ``kinds`` adds ``o_kind`` (iri, literal or blank)."""
    parsed = _scan(spark, path).filter(F.col("_s") != "")
    more = [_kind(F.col("_o")).alias("o_kind")] if kinds else []
    return parsed.select(_unterm(F.col("_s")).alias("s"), _unterm(F.col("_p")).alias("p"), _unterm(F.col("_o")).alias("o"), *more)


def ntriples_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither a triple, nor a comment, nor blank."""
    return _scan(spark, path).filter((F.col("_s") == "") & ~F.col("value").rlike(r"^\s*(#.*)?$")).select("value")


def to_ntriples(triples: DataFrame) -> DataFrame:
    """Render (s, p, o) as N-Triples lines.

    A column ``o_kind`` (iri, literal or blank) says what the object is; without it an
    object that reads as an IRI or a blank node is one, all others are literals.
    """
    def node(c):
        return F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    o = F.col("o")
    kind = F.col("o_kind") if "o_kind" in triples.columns else F.when(o.rlike(r"^_:\S+$"), F.lit("blank")).when(
        o.rlike(IRI), F.lit("iri")).otherwise(F.lit("literal"))
    obj = F.when(kind == "literal", F.concat(F.lit('"'), _escaped(o), F.lit('"'))).otherwise(node(o))
    return triples.select(F.concat_ws(" ", node(F.col("s")), node(F.col("p")), obj, F.lit(".")).alias("value"))


def pred(triples, p: str, s: str = "s", o: str = "o") -> DataFrame:
    """Triples of one predicate as a two-column frame (one basic pattern).

    ``triples`` is a frame (s, p, o) of terms or a ``TripleStore``, whose nodes are ids;
    all operators below take either and return nodes as they got them.
    """
    if not isinstance(triples, DataFrame):
        return triples.pred(p, s, o)
    return triples.filter(F.col("p") == p).select(F.col("s").alias(s), F.col("o").alias(o))


def _texts(triples, p: str, s: str, o: str) -> DataFrame:
    """As ``pred``, for a predicate whose objects are literals."""
    return pred(triples, p, s, o) if isinstance(triples, DataFrame) else triples.text(p, s, o)


def _node(triples, term: str) -> Column:
    return F.lit(term) if isinstance(triples, DataFrame) else triples.node(term)


def is_node(o: Column) -> Column:
    """Whether a text reads as a blank node or as an IRI.

    The pattern of an IRI is slow, so it is tried only on texts that are neither common words nor IRIs of plain characters.
    """
    return F.when(o.startswith("_:"), o.rlike(r"^_:\S+$")).otherwise(o.isin(*_COMMON) | o.rlike(_PLAIN_IRI) | o.rlike(IRI))


def local_name(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.substring_index(col, "#", -1)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def open_writers(spark: SparkSession, most: int = 64):
    """Tasks keep a file open for each of up to ``most`` partitions, and sort their rows by partition only beyond that."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of a job go when it ends, not when the driver happens to collect its garbage.

    For frames made and run within, once.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def passing(spark: SparkSession):
    """Tables that ``_cut`` writes within are dropped at the end."""
    token = _WRITTEN.set(paths := [])
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in paths:
            drop_scratch(spark, path)


def _cut(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and the planner knows its size.

    Rows that differ in the last columns ``parts`` lie in files of their own.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "round")
    if (paths := _WRITTEN.get()) is not None:
        paths.append(path)
    with shuffles_dropped(spark), open_writers(spark) if parts else nullcontext():
        (df.write.partitionBy(*parts) if parts else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The rows of ``make()``, stored; tables that ``_cut`` wrote on the way to them are dropped."""
    outer = _WRITTEN.get()
    with passing(spark):
        rows = make()
        token = _WRITTEN.set(outer)
        try:
            return _cut(rows)
        finally:
            _WRITTEN.reset(token)


ROWS_A_TASK = 1_000_000
FEW_ROWS = 100_000


def hash_join(rows: DataFrame, table: DataFrame, key: str, most: int) -> DataFrame:
    """``rows`` joined with ``table`` of about ``most`` rows, whose keys are nearly all different.

    Neither side is sorted: a task holds its share of ``table``, so the table is dealt to as many tasks as keep that small,
    and few rows go to every task.
    """
    if most <= FEW_ROWS:
        return rows.join(F.broadcast(table), key)
    n = most // ROWS_A_TASK + 1
    if n > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows, table = rows.repartition(n, key), table.repartition(n, key)
    return rows.join(table.hint("shuffle_hash"), key)


# --- J9: list expansion ------------------------------------------------------------------
def list_items(triples, heads: DataFrame) -> DataFrame:
    """``?head rdf:rest*/rdf:first ?item`` for the given heads -> (head, pos, item).

    Forward pointer jumping: after k rounds each head has its first 2^k nodes, and a
    table leads from a node to its 2^k-th successor.  Heads may lie inside other
    lists and lists may share tails.  A round is one join: what is reached and the table
    itself (its rows have no position) are led on together.  It writes only its new rows,
    and there is none once the table is empty.  A cyclic list has no end, so it raises an error.
    """
    first = pred(triples, RDF_FIRST, "node", "item")
    rest = pred(triples, RDF_REST, "node", "next").filter(F.col("next") != _node(triples, RDF_NIL))
    jump, step = rest, 1
    nodes = left = rest.count()
    no_pos = F.lit(None).cast("long").alias("pos")
    reached = heads.select("head").distinct().select("head", F.col("head").alias("node"), F.lit(0).cast("long").alias("pos"))
    reached = _cut(reached)
    while left:
        going = reached.unionByName(jump.select(F.col("node").alias("head"), F.col("next").alias("node"), no_pos))
        led = _cut(hash_join(going, jump, "node", left).select(
            "head", F.col("next").alias("node"), (F.col("pos") + step).alias("pos"), F.col("pos").isNull().alias("link")), "link")
        new = led.filter("not link").select("head", "node", "pos")
        if new.isEmpty():
            break
        if step > nodes:
            raise ValueError("a list is cyclic")
        reached = reached.unionByName(new)
        step *= 2
        jump = led.filter("link").select(F.col("head").alias("node"), F.col("node").alias("next"))
        left = jump.count()
    return hash_join(reached, first, "node", first.count()).select("head", "pos", "item")


# --- A12: maxima over lists, without their expansion -----------------------------------------
def list_nodes(triples, values: DataFrame) -> DataFrame:
    """(node, next, full, others of ``values``) of each list node; ``values`` has (item, others).

    ``next`` is null at the end of a list; ``full`` says whether the node has a member.
    """
    names = [c for c in values.columns if c != "item"]
    nothing = [F.lit(None).cast(values.schema[c].dataType).alias(c) for c in names]
    rest = pred(triples, RDF_REST, "node", "next")
    after = F.when(F.col("next") != _node(triples, RDF_NIL), F.col("next"))
    none = F.lit(None).cast(rest.schema["next"].dataType)
    own = _cut(pred(triples, RDF_FIRST, "node", "item").join(values, "item", "left").select("node", *names))
    rows = (own.select("node", none.alias("next"), F.lit(True).alias("full"), *names)
            .unionByName(rest.select("node", after.alias("next"), F.lit(False).alias("full"), *nothing)))
    each = rows.groupBy("node").agg(F.min("next").alias("next"), F.max("next").alias("_last"), F.max("full").alias("full"),
                                    *[F.max(c).alias(c) for c in names])
    one_way = F.when(F.col("next") == F.col("_last"), F.col("next")).when(
        F.col("next").isNotNull(), F.raise_error(F.lit("a list node has two successors")).cast(rest.schema["next"].dataType))
    return each.select("node", one_way.alias("next"), "full", *names)


def list_maxima(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of ``heads`` (head, any others) with the largest values over the members of the head's list, nulls skipped.

    ``nodes`` is a stored ``list_nodes``.  After k rounds a node holds the maxima of its first 2^k
    nodes and leads to the one behind them; one join a round, and only nodes whose list goes on take
    part in it.  A node that is only led to has no row and ends its list.  A head whose list has no members has no row; a cyclic list has no end and a node with
    two successors no one list, so both raise an error.
    """
    names = [c for c in nodes.columns if c not in ("node", "next", "full")]
    done, going, step, count = nodes.filter("next is null"), nodes.filter("next is not null"), 1, nodes.count()
    while True:
        left = going.count()
        if not left:
            break
        if step > count:  # what still goes on leads into a cycle
            if heads.join(going, F.col("head") == F.col("node"), "left_semi").isEmpty():
                break
            raise ValueError("a list is cyclic")
        ahead = done.unionByName(going)
        ahead = ahead.select(*[F.col(c).alias(f"_{c}") for c in ahead.columns])
        if left <= FEW_ROWS:  # what they lead to is found where it lies
            ahead = F.broadcast(ahead.join(F.broadcast(going.select(F.col("next").alias("_node")).distinct()), "_node", "left_semi"))
        jumped = _cut(going.join(ahead, F.col("next") == F.col("_node"), "left").select(
            "node", F.col("_next").alias("next"), (F.col("full") | F.coalesce("_full", F.lit(False))).alias("full"),
            *[F.greatest(c, f"_{c}").alias(c) for c in names]))
        done = done.unionByName(jumped.filter("next is null"))
        going, step = jumped.filter("next is not null"), 2 * step
    return heads.join(done.filter("full").select(F.col("node").alias("head"), *names), "head")


# --- D5: transitive closure of a relation ---------------------------------------------------
def transitive_closure(edges: DataFrame, src: str = "c", dst: str = "p") -> DataFrame:
    """All (a, b) with a path a -> ... -> b.

    Semi-naive doubling: each round composes only pairs that involve a pair found in
    the previous round (delta o C and C o delta), keeps those not yet known (anti-join),
    and stops when a round finds nothing new.  Paths of length up to 2^k are known
    after k rounds, and late rounds touch only the shrinking frontier."""
    c = _cut(edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).distinct())
    delta = c
    def cols(df, x, y):  # fresh attribute names per use: the same plan joins itself
        return df.select(F.col("a").alias(x), F.col("b").alias(y))
    while True:  # ends: the pairs of a finite relation are finite
        left = (cols(delta, "da", "db").join(cols(c, "ra", "rb"), F.col("db") == F.col("ra"))
                .select(F.col("da").alias("a"), F.col("rb").alias("b")))
        right = (cols(c, "la", "lb").join(cols(delta, "xa", "xb"), F.col("lb") == F.col("xa"))
                 .select(F.col("la").alias("a"), F.col("xb").alias("b")))
        known = cols(c, "ka", "kb")
        fresh = _cut(left.unionByName(right).distinct().join(
            known, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")), "left_anti"))
        if fresh.isEmpty():
            break
        c = _cut(c.unionByName(fresh))
        delta = fresh
    return c.select(F.col("a").alias(src), F.col("b").alias(dst))


# --- J7 / J8 / A12 / D1: range constraints from restriction patterns ----------------------------
def _restrictions(triples, strict: bool) -> DataFrame:
    sub = pred(triples, SUBCLASS, "cls", "r")
    onp = pred(triples, ON_PROPERTY, "r", "prop")
    avf = pred(triples, ALL_VALUES_FROM, "r", "range")
    wr = pred(triples, WITH_RESTRICTIONS, "range", "head")
    bgp = onp.join(avf, "r").join(sub, "r").join(wr, "range")
    return bgp.join(pred(triples, ON_DATATYPE, "range", "dt"), "range") if strict else bgp


def restriction_ranges(triples, strict: bool = False) -> DataFrame:
    """The restriction pattern, one row per (class, restriction, property, item):

        ?class rdfs:subClassOf ?r . ?r owl:onProperty ?prop ; owl:allValuesFrom ?range .
        [strict: ?range owl:onDatatype ?dt .] ?range owl:withRestrictions ?list .
        ?list rdf:rest*/rdf:first ?item .
        OPTIONAL { ?item xsd:minInclusive ?min }  OPTIONAL { ?item xsd:maxInclusive ?max }
    """
    # the pattern first, once: only the lists that it leaves are expanded
    bgp = _cut(_restrictions(triples, strict))
    items = list_items(triples, bgp.select("head"))
    mins = _texts(triples, MIN_INCL, "item", "min")
    maxs = _texts(triples, MAX_INCL, "item", "max")
    return (bgp.join(items, "head").join(mins, "item", "left").join(maxs, "item", "left")
            .select("cls", "r", "prop", "item", "min", "max"))


def number(c: str | Column) -> Column:
    """Literal -> double; U+2212 MINUS SIGN is read as '-' and bad text gives null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.translate(col, "−", "-").try_cast("double")


def fold_constraints(rows: DataFrame) -> DataFrame:
    """One row per property local name: the largest stated min and max (nulls skipped)."""
    return (rows.groupBy(local_name("prop").alias("property"))
            .agg(F.max(number("min")).alias("min"), F.max(number("max")).alias("max")))


def property_ranges(triples, strict: bool = False) -> DataFrame:
    """As ``fold_constraints(restriction_ranges(...))``, with no list expanded: limits are folded along the
    lists, then by property node, and only the few properties left are decoded."""
    nothing = F.lit(None).cast("double")
    limits = (_texts(triples, MIN_INCL, "item", "v").select("item", number("v").alias("min"), nothing.alias("max"))
              .unionByName(_texts(triples, MAX_INCL, "item", "v").select("item", nothing.alias("min"), number("v").alias("max"))))
    spark = limits.sparkSession

    def by_node():
        lists = _cut(_restrictions(triples, strict).select("prop", "head").distinct())
        nodes = settled(spark, lambda: list_nodes(triples, limits))
        return list_maxima(nodes, lists).groupBy("prop").agg(F.max("min").alias("min"), F.max("max").alias("max"))

    folded = settled(spark, by_node)
    if not isinstance(triples, DataFrame):
        folded = triples.decode(folded, "prop")
    return folded.groupBy(local_name("prop").alias("property")).agg(F.max("min").alias("min"), F.max("max").alias("max"))
