"""Disk that the list queries take: shuffle files go with their job, rounds with their result, ids are not stored beside terms."""

import glob
import time

import pytest

from conftest import SMALL
from sensorweave.operators import rdf as RD
from sensorweave.operators.triple_store import TripleStore
from sensorweave.plans import rdf_queries as Q
from sensorweave.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _rounds(spark):
    return set(glob.glob(f"{ensure_checkpoint_dir(spark)}/sensorweave/round-*"))


def _shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(files.apply(i)) for i in range(files.size()) if str(files.apply(i)).startswith("shuffle_")}


def _lists(n, length):
    rows = []
    for a in range(n):
        nodes = [f"_:n{a}_{i}" for i in range(length + a % 3)]
        rows += [(f"_:c{a}", RD.SUBCLASS, f"_:r{a}"), (f"_:r{a}", RD.ON_PROPERTY, f"http://a.b/c#p{a % 2}"),
                 (f"_:r{a}", RD.ALL_VALUES_FROM, f"_:d{a}"), (f"_:d{a}", RD.WITH_RESTRICTIONS, nodes[0])]
        rows += [(x, RD.RDF_REST, y) for x, y in zip(nodes, [*nodes[1:], RD.RDF_NIL], strict=True)]
        rows += [(x, RD.RDF_FIRST, f"_:i{x[2:]}") for x in nodes] + [(f"_:i{x[2:]}", RD.MAX_INCL, str(a)) for x in nodes]
    return rows


def test_a_round_leaves_no_shuffle(spark):
    shuffled = _shuffled(spark)
    rows = RD._cut(spark.range(1000).repartition(7, "id"))
    for _ in range(100):  # the files go beside the driver's work
        if not (left := _shuffled(spark) - shuffled):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP) == "false" and rows.count() == 1000


def test_constraints_leave_no_round(spark):
    store = TripleStore.build(spark.createDataFrame(_lists(20, 5), "s string, p string, o string"))
    rounds = _rounds(spark)
    got = RD.property_ranges(store)
    assert len(_rounds(spark) - rounds) == 1  # the folded rows
    assert sorted(map(tuple, got.collect())) == [("p0", None, 18.0), ("p1", None, 19.0)]


def test_list_items_leave_one_table(spark, monkeypatch):
    store = TripleStore.build(spark.createDataFrame(_lists(6, 9), "s string, p string, o string"))
    monkeypatch.setattr(Q, "triple_store", lambda *_: store)
    rounds = _rounds(spark)
    got = Q.rdf_list_items(spark, "")
    assert len(_rounds(spark) - rounds) == 1
    assert sorted(map(tuple, got.collect())) == sorted((f"_:n{a}_0", i, f"_:in{a}_{i}") for a in range(6) for i in range(9 + a % 3))


def test_the_store_holds_terms_without_ids_and_no_numbered_rows(spark, monkeypatch):
    rounds = _rounds(spark)
    monkeypatch.setattr(Q, "_STORES", {})
    store = Q.triple_store(spark, SMALL)
    assert _rounds(spark) == rounds
    assert spark.read.parquet(f"{store.root}/terms").columns == ["term"]
    term = store.terms.first()["term"]
    assert store.terms.select("id").where(store.terms.term == term).first()["id"] == store.terms.select(store.node(term)).first()[0]


def test_a_failure_drops_what_it_wrote(spark):
    rounds = _rounds(spark)
    rest = [("a", "b"), ("b", "a")]
    triples = spark.createDataFrame([(a, RD.RDF_REST, b) for a, b in rest], "s string, p string, o string")
    with pytest.raises(ValueError):
        RD.settled(spark, lambda: RD.list_items(triples, spark.createDataFrame([("a",)], "head string")))
    assert _rounds(spark) == rounds


@pytest.mark.parametrize("few", [0, 100_000])
def test_maxima_where_lists_end_in_a_node_without_a_row(spark, monkeypatch, few):
    """Nodes that are only led to have no row; the last rounds, of few nodes, shuffle nothing."""
    monkeypatch.setattr(RD, "FEW_ROWS", few)
    rest = [(f"n{i}", f"n{i + 1}") for i in range(11)] + [("m0", "m1"), ("m1", RD.RDF_NIL)]
    rows = [(a, RD.RDF_REST, b) for a, b in rest] + [(a, RD.RDF_FIRST, "i" + a) for a, _ in rest]
    triples = spark.createDataFrame(rows, "s string, p string, o string")
    values = spark.createDataFrame([("in9", 7.0), ("in3", 9.0), ("im1", 1.0)], "item string, v double")
    nodes = RD._cut(RD.list_nodes(triples, values))
    assert sorted(r["node"] for r in nodes.collect()) == sorted(a for a, _ in rest)
    heads = spark.createDataFrame([(h,) for h in ("n0", "n4", "n10", "n11", "m0")], "head string")
    assert {r["head"]: r["v"] for r in RD.list_maxima(nodes, heads).collect()} == {"n0": 9.0, "n4": 7.0, "n10": None, "m0": 1.0}
