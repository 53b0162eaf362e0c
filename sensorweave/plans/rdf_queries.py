"""RDF / ontology queries over a triples table built by Spark from the given tables.

Triples = the sensor ontology's class hierarchy and range restrictions (fixed
values) plus a hierarchy and restriction lists derived from the data:

  region / nation / customer      owl:Class each; customer subClassOf nation subClassOf region
  order o                         customer subClassOf _:r<o>, a restriction on
                                  tb:hasPriority_<o_orderpriority, blanks as _>,
                                  allValuesFrom _:d<o> (rdf:type xsd:float, and
                                  owl:onDatatype xsd:float when o_orderstatus = 'F'),
                                  owl:withRestrictions the list _:l<o>_1
  line item #n of order o         list node _:l<o>_n -> item _:i<o>_n; odd n states
                                  xsd:minInclusive l_discount, even n xsd:maxInclusive
                                  l_extendedprice (numbers as text)
  second item of every 5th order  _:x<o> -> item _:i<o>_1 with the tail _:l<o>_2 shared, stated
                                  by _:e<o>; _:g<o> states the interior node _:l<o>_2 as a list
  every 10th customer             rdfs:label with a colon, quotes, a backslash, a tab and a line end

Line items are numbered by their rank over (l_linenumber, l_partkey, l_suppkey,
l_quantity, l_extendedprice, l_shipdate) within the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import rdf as RD
from ..operators import reachability as RC
from ..operators.ranking import numbered
from ..operators.triple_store import TripleStore
from ..session import scratch_path
from ..sources.tables import read_table, tables_state
from .registry import register

KB = fixed.KB_NAMESPACE
TB = "http://example.org/tables#"
LABEL = fixed.RDFS + "label"
LABEL_TEXT = 'note: a "quoted" back\\slash\tand\na line of customer '
LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def kb_rows() -> list[tuple[str, str, str]]:
    """The ontology's class hierarchy and range restrictions as triples."""
    rows = []
    classes = sorted({c for pair in fixed.KB_SUBCLASS for c in pair})
    rows += [(KB + c, RD.RDF_TYPE, RD.OWL_CLASS) for c in classes]
    rows += [(KB + c, RD.SUBCLASS, KB + p) for c, p in fixed.KB_SUBCLASS]
    for i, (cls, prop, lo, hi) in enumerate(fixed.KB_RESTRICTIONS):
        r, d, la, lb, ia, ib = (f"_:kr{i}", f"_:kd{i}", f"_:kl{i}a", f"_:kl{i}b", f"_:ki{i}a", f"_:ki{i}b")
        rows += [
            (KB + cls, RD.SUBCLASS, r), (r, RD.RDF_TYPE, RD.OWL_RESTRICTION),
            (r, RD.ON_PROPERTY, KB + prop), (r, RD.ALL_VALUES_FROM, d),
            (d, RD.RDF_TYPE, fixed.XSD + "float"),  # the KB writes rdf:type, not owl:onDatatype
            (d, RD.WITH_RESTRICTIONS, la),
            (la, RD.RDF_FIRST, ia), (la, RD.RDF_REST, lb), (lb, RD.RDF_FIRST, ib),
            (lb, RD.RDF_REST, RD.RDF_NIL),
            (ia, RD.MIN_INCL, lo), (ib, RD.MAX_INCL, hi),
        ]
    return rows


def kb_triples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(kb_rows(), "s string, p string, o string")


def _t(s, p, o):
    return F.struct(s.alias("s"), (p if not isinstance(p, str) else F.lit(p)).alias("p"),
                    (o if not isinstance(o, str) else F.lit(o)).alias("o"))


def table_triples(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Triples derived from region / nation / customer / orders / lineitem (narrow
    projections plus one per-order numbering of line items).  Where they are read ``again``,
    the numbered rows are stored, which are narrower than the triples."""
    iri = lambda kind, c: F.concat(F.lit(f"{TB}{kind}_"), F.col(c).cast("string"))
    bn = lambda kind, c: F.concat(F.lit(f"_:{kind}"), F.col(c).cast("string"))
    region = read_table(spark, sf_dir, "region", ["r_regionkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                                  "o_orderpriority"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_discount", *LI_ORDER])
    t_region = region.select(F.inline(F.array(_t(iri("Region", "r_regionkey"), RD.RDF_TYPE, RD.OWL_CLASS))))
    t_nation = nation.select(F.inline(F.array(
        _t(iri("Nation", "n_nationkey"), RD.RDF_TYPE, RD.OWL_CLASS),
        _t(iri("Nation", "n_nationkey"), RD.SUBCLASS, iri("Region", "n_regionkey")))))
    t_cust = cust.select(F.inline(F.array(
        _t(iri("Customer", "c_custkey"), RD.RDF_TYPE, RD.OWL_CLASS),
        _t(iri("Customer", "c_custkey"), RD.SUBCLASS, iri("Nation", "c_nationkey")))))
    r, d = bn("r", "o_orderkey"), bn("d", "o_orderkey")
    prop = F.concat(F.lit(f"{TB}hasPriority_"), F.translate("o_orderpriority", " ", "_"))
    head = F.concat(bn("l", "o_orderkey"), F.lit("_1"))
    strict = F.when(F.col("o_orderstatus") == "F", F.array(_t(d, RD.ON_DATATYPE, fixed.XSD + "float"))) \
        .otherwise(F.array().cast("array<struct<s:string,p:string,o:string>>"))
    t_orders = orders.select(F.inline(F.concat(F.array(
        _t(iri("Customer", "o_custkey"), RD.SUBCLASS, r), _t(r, RD.RDF_TYPE, RD.OWL_RESTRICTION),
        _t(r, RD.ON_PROPERTY, prop), _t(r, RD.ALL_VALUES_FROM, d),
        _t(d, RD.RDF_TYPE, fixed.XSD + "float"), _t(d, RD.WITH_RESTRICTIONS, head)), strict)))
    # position of each line item in its order; an order too large for one task
    # is spread over many (see operators.ranking)
    num = (numbered(li, ["l_orderkey"], LI_ORDER)
           .select("l_orderkey", "l_discount", "l_extendedprice",
                   F.col("rank").alias("n"), F.col("group_size").alias("cnt")))
    num = RD._cut(num) if again else num
    node = lambda k, n: F.concat(F.lit(f"_:{k}"), F.col("l_orderkey").cast("string"), F.lit("_"),
                                 n.cast("string"))
    num = num.select("*", node("l", F.col("n")).alias("lst"), node("i", F.col("n")).alias("item"))  # a text for all its triples
    lst, item = F.col("lst"), F.col("item")
    nxt = F.when(F.col("n") == F.col("cnt"), F.lit(RD.RDF_NIL)).otherwise(node("l", F.col("n") + 1))
    facet = F.when(F.col("n") % 2 == 1, _t(item, RD.MIN_INCL, F.col("l_discount").cast("string"))) \
        .otherwise(_t(item, RD.MAX_INCL, F.col("l_extendedprice").cast("string")))
    o = F.col("l_orderkey").cast("string")
    bno = lambda k: F.concat(F.lit(f"_:{k}"), o)
    # as another branch of the union, the second items would be numbered once more
    shared = F.when((F.col("l_orderkey") % 5 == 0) & (F.col("n") == 2), F.array(
        _t(bno("e"), RD.WITH_RESTRICTIONS, bno("x")), _t(bno("x"), RD.RDF_FIRST, F.concat(bno("i"), F.lit("_1"))),
        _t(bno("x"), RD.RDF_REST, F.concat(bno("l"), F.lit("_2"))), _t(bno("g"), RD.WITH_RESTRICTIONS, F.concat(bno("l"), F.lit("_2"))))) \
        .otherwise(F.array().cast("array<struct<s:string,p:string,o:string>>"))
    t_li = num.select(F.inline(F.concat(F.array(_t(lst, RD.RDF_FIRST, item), _t(lst, RD.RDF_REST, nxt), facet), shared)))
    t_label = cust.filter(F.col("c_custkey") % 10 == 0).select(F.inline(F.array(
        _t(iri("Customer", "c_custkey"), LABEL, F.concat(F.lit(LABEL_TEXT), F.col("c_custkey").cast("string"))))))
    return (t_region.unionByName(t_nation).unionByName(t_cust).unionByName(t_orders).unionByName(t_li)
            .unionByName(t_label))


def triples(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    return kb_triples(spark).unionByName(table_triples(spark, sf_dir, again))


TRIPLE_TABLES = ["region", "nation", "customer", "orders", "lineitem"]
_STORES: dict[tuple, TripleStore] = {}


def triple_store(spark: SparkSession, sf_dir: str) -> TripleStore:
    """The triples on ids, stored once per application and state of the tables' files."""
    key = (spark, spark.sparkContext.applicationId, tables_state(spark, sf_dir, TRIPLE_TABLES))
    if key not in _STORES:
        with RD.passing(spark):  # the numbered line items, once stored as triples
            _STORES[key] = TripleStore.build(triples(spark, sf_dir, True))
    return _STORES[key]


# --- the same triples in DuckDB ---------------------------------------------------------------
def _kb_values_sql() -> str:
    def q(x):
        return "'" + x.replace("'", "''") + "'"
    return ",\n    ".join(f"({q(s)}, {q(p)}, {q(o)})" for s, p, o in kb_rows())


def triples_sql() -> str:
    X = fixed.XSD
    return f"""
num AS (SELECT l_orderkey, l_discount, l_extendedprice,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LI_ORDER)}) AS n,
    count(*) OVER (PARTITION BY l_orderkey) AS cnt FROM lineitem),
triples AS (
  SELECT * FROM (VALUES
    {_kb_values_sql()}) kb(s, p, o)
  UNION ALL SELECT '{TB}Region_' || r_regionkey, '{RD.RDF_TYPE}', '{RD.OWL_CLASS}' FROM region
  UNION ALL SELECT '{TB}Nation_' || n_nationkey, '{RD.RDF_TYPE}', '{RD.OWL_CLASS}' FROM nation
  UNION ALL SELECT '{TB}Nation_' || n_nationkey, '{RD.SUBCLASS}', '{TB}Region_' || n_regionkey FROM nation
  UNION ALL SELECT '{TB}Customer_' || c_custkey, '{RD.RDF_TYPE}', '{RD.OWL_CLASS}' FROM customer
  UNION ALL SELECT '{TB}Customer_' || c_custkey, '{RD.SUBCLASS}', '{TB}Nation_' || c_nationkey FROM customer
  UNION ALL SELECT '{TB}Customer_' || o_custkey, '{RD.SUBCLASS}', '_:r' || o_orderkey FROM orders
  UNION ALL SELECT '_:r' || o_orderkey, '{RD.RDF_TYPE}', '{RD.OWL_RESTRICTION}' FROM orders
  UNION ALL SELECT '_:r' || o_orderkey, '{RD.ON_PROPERTY}', '{TB}hasPriority_' || replace(o_orderpriority, ' ', '_') FROM orders
  UNION ALL SELECT '_:r' || o_orderkey, '{RD.ALL_VALUES_FROM}', '_:d' || o_orderkey FROM orders
  UNION ALL SELECT '_:d' || o_orderkey, '{RD.RDF_TYPE}', '{X}float' FROM orders
  UNION ALL SELECT '_:d' || o_orderkey, '{RD.WITH_RESTRICTIONS}', '_:l' || o_orderkey || '_1' FROM orders
  UNION ALL SELECT '_:d' || o_orderkey, '{RD.ON_DATATYPE}', '{X}float' FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT '_:l' || l_orderkey || '_' || n, '{RD.RDF_FIRST}', '_:i' || l_orderkey || '_' || n FROM num
  UNION ALL SELECT '_:l' || l_orderkey || '_' || n, '{RD.RDF_REST}',
    CASE WHEN n = cnt THEN '{RD.RDF_NIL}' ELSE '_:l' || l_orderkey || '_' || (n + 1) END FROM num
  UNION ALL SELECT '_:i' || l_orderkey || '_' || n,
    CASE WHEN n % 2 = 1 THEN '{RD.MIN_INCL}' ELSE '{RD.MAX_INCL}' END,
    CASE WHEN n % 2 = 1 THEN CAST(l_discount AS VARCHAR) ELSE CAST(l_extendedprice AS VARCHAR) END FROM num
  UNION ALL SELECT '_:e' || l_orderkey, '{RD.WITH_RESTRICTIONS}', '_:x' || l_orderkey FROM num WHERE l_orderkey % 5 = 0 AND n = 2
  UNION ALL SELECT '_:x' || l_orderkey, '{RD.RDF_FIRST}', '_:i' || l_orderkey || '_1' FROM num WHERE l_orderkey % 5 = 0 AND n = 2
  UNION ALL SELECT '_:x' || l_orderkey, '{RD.RDF_REST}', '_:l' || l_orderkey || '_2' FROM num WHERE l_orderkey % 5 = 0 AND n = 2
  UNION ALL SELECT '_:g' || l_orderkey, '{RD.WITH_RESTRICTIONS}', '_:l' || l_orderkey || '_2' FROM num WHERE l_orderkey % 5 = 0 AND n = 2
  UNION ALL SELECT '{TB}Customer_' || c_custkey, '{LABEL}', '{LABEL_TEXT}' || c_custkey FROM customer WHERE c_custkey % 10 = 0
)"""


def with_triples(body: str, *extra: str) -> str:
    ctes = ",\n".join([triples_sql().strip(), *[e.strip() for e in extra]])
    return f"WITH {ctes}\n{body.strip()}"


# --- S6: triples scan (written as N-Triples text, scanned back) -------------------------------------
@register("rdf_triples", sql=with_triples("SELECT s, p, o FROM triples"))
def rdf_triples(spark, sf_dir):
    path = scratch_path(spark, "ntriples")
    # lines repeat their prefixes, so the text is a tenth of its size; each task's file is one task's read
    RD.to_ntriples(triples(spark, sf_dir)).write.option("compression", "gzip").text(path)
    return RD.read_ntriples(spark, path)


# --- X11: local names of every IRI in predicate or class position ------------------------------------
@register("rdf_local_name", sql=with_triples("""
SELECT DISTINCT iri, split_part(iri, '#', -1) AS local_name FROM (
  SELECT p AS iri FROM triples UNION ALL SELECT o FROM triples WHERE p = '""" + RD.RDF_TYPE + """'
) x WHERE iri LIKE 'http%'"""))
def rdf_local_name(spark, sf_dir):
    t = triple_store(spark, sf_dir)
    types = t.decode(RD._cut(t.pred(RD.RDF_TYPE, "s", "iri").select("iri").distinct()), "iri")  # few, and stored: the dictionary stays where it is
    iris = t.facts.select(F.col("p").alias("iri")).distinct().unionByName(types)
    return (iris.filter(F.col("iri").startswith("http")).distinct()
            .select("iri", RD.local_name("iri").alias("local_name")))


# --- J9: list expansion -------------------------------------------------------------------------------
@register("rdf_list_items", sql=with_triples(f"""
SELECT head, pos, f.o AS item FROM lp JOIN triples f ON f.s = lp.node AND f.p = '{RD.RDF_FIRST}'""",
    f"""lp AS (
  WITH RECURSIVE walk(head, node, pos) AS (
    SELECT o, o, 0 FROM triples WHERE p = '{RD.WITH_RESTRICTIONS}'
    UNION ALL
    SELECT w.head, t.o, w.pos + 1 FROM walk w JOIN triples t
      ON t.s = w.node AND t.p = '{RD.RDF_REST}' AND t.o <> '{RD.RDF_NIL}'
  ) SELECT * FROM walk)"""))
def rdf_list_items(spark, sf_dir):
    """Every restriction list expanded: (head, pos, item)."""
    t = triple_store(spark, sf_dir)
    heads = RD.pred(t, RD.WITH_RESTRICTIONS, "range", "head").select("head")
    items = RD.settled(spark, lambda: RD.list_items(t, heads))
    return t.decode(items, "head", "item", large=True)


# --- J11 / F5: subclass pairs whose both ends are classes ---------------------------------------------------
SUBCLASS_PAIRS_SQL = f"""pairs AS (
  SELECT t.s AS class, t.o AS superclass FROM triples t
  WHERE t.p = '{RD.SUBCLASS}'
    AND t.s IN (SELECT s FROM triples WHERE p = '{RD.RDF_TYPE}' AND o = '{RD.OWL_CLASS}')
    AND t.o IN (SELECT s FROM triples WHERE p = '{RD.RDF_TYPE}' AND o = '{RD.OWL_CLASS}'))"""


def subclass_pairs(t: TripleStore) -> DataFrame:
    """(class, superclass) ids, both of them classes."""
    cls = RD.pred(t, RD.RDF_TYPE, "c", "o").filter(F.col("o") == t.node(RD.OWL_CLASS)).select("c").distinct()
    sub = RD.pred(t, RD.SUBCLASS, "class", "superclass")
    return (sub.join(cls.withColumnRenamed("c", "class"), "class", "left_semi")
            .join(cls.withColumnRenamed("c", "superclass"), "superclass", "left_semi")
            .select("class", "superclass"))


@register("rdf_subclass_pairs", sql=with_triples("SELECT class, superclass FROM pairs", SUBCLASS_PAIRS_SQL))
def rdf_subclass_pairs(spark, sf_dir):
    """All pairs, ordered (the report previewed the first 100)."""
    t = triple_store(spark, sf_dir)
    return t.decode(subclass_pairs(t), "class", "superclass").orderBy("class", "superclass")


@register("rdf_subclass_preview", sql=with_triples(
    "SELECT class, superclass FROM pairs ORDER BY class, superclass LIMIT 100", SUBCLASS_PAIRS_SQL))
def rdf_subclass_preview(spark, sf_dir, limit: int = 100):
    """The report's preview: the first ``limit`` pairs in a total order."""
    return rdf_subclass_pairs(spark, sf_dir).limit(limit)


# --- D5: transitive subclass closure ------------------------------------------------------------------------
CLOSURE_SQL = with_triples("SELECT class, superclass FROM closure", SUBCLASS_PAIRS_SQL, """
closure AS (
  WITH RECURSIVE cl(class, superclass) AS (
    SELECT class, superclass FROM pairs
    UNION
    SELECT cl.class, p.superclass FROM cl JOIN pairs p ON cl.superclass = p.class
  ) SELECT * FROM cl)""")


@register("rdf_subclass_closure", sql=CLOSURE_SQL)
def rdf_subclass_closure(spark, sf_dir):
    t = triple_store(spark, sf_dir)
    return t.decode(RD.transitive_closure(subclass_pairs(t), "class", "superclass"), "class", "superclass")


@register("rdf_subclass_index", sql=CLOSURE_SQL)
def rdf_subclass_index(spark, sf_dir):
    """The same pairs by range tests on interval labels."""
    t = triple_store(spark, sf_dir)
    found = RC.below(*RC.label(subclass_pairs(t), "class", "superclass"))
    return t.decode(found.select(F.col("node").alias("class"), F.col("above").alias("superclass")), "class", "superclass")


# --- D1 / J7 / J8 / A12: constraints --------------------------------------------------------------------------
def constraints_sql(strict: bool) -> str:
    dt = f"JOIN triples dt ON dt.s = avf.o AND dt.p = '{RD.ON_DATATYPE}'" if strict else ""
    return with_triples(f"""
SELECT split_part(onp.o, '#', -1) AS property,
       max(TRY_CAST(replace(mn.o, '−', '-') AS DOUBLE)) AS min,
       max(TRY_CAST(replace(mx.o, '−', '-') AS DOUBLE)) AS max
FROM triples sub
JOIN triples onp ON onp.s = sub.o AND onp.p = '{RD.ON_PROPERTY}'
JOIN triples avf ON avf.s = sub.o AND avf.p = '{RD.ALL_VALUES_FROM}'
JOIN triples wr ON wr.s = avf.o AND wr.p = '{RD.WITH_RESTRICTIONS}'
{dt}
JOIN lp ON lp.head = wr.o
JOIN triples f ON f.s = lp.node AND f.p = '{RD.RDF_FIRST}'
LEFT JOIN triples mn ON mn.s = f.o AND mn.p = '{RD.MIN_INCL}'
LEFT JOIN triples mx ON mx.s = f.o AND mx.p = '{RD.MAX_INCL}'
WHERE sub.p = '{RD.SUBCLASS}'
GROUP BY 1""", f"""lp AS (
  WITH RECURSIVE walk(head, node) AS (
    SELECT DISTINCT o, o FROM triples WHERE p = '{RD.WITH_RESTRICTIONS}'
    UNION ALL
    SELECT w.head, t.o FROM walk w JOIN triples t
      ON t.s = w.node AND t.p = '{RD.RDF_REST}' AND t.o <> '{RD.RDF_NIL}'
  ) SELECT * FROM walk)""")


@register("constraints", headline=True, sql=constraints_sql(False))
def constraints(spark, sf_dir):
    """Range per property from restriction lists (owl:onDatatype not required)."""
    t = triple_store(spark, sf_dir)
    return RD.property_ranges(t)


@register("constraints_strict", sql=constraints_sql(True))
def constraints_strict(spark, sf_dir):
    """The reference's exact pattern: requires owl:onDatatype (the KB part yields nothing)."""
    t = triple_store(spark, sf_dir)
    return RD.property_ranges(t, strict=True)
