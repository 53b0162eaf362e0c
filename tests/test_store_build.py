"""What building and reading the stored triples costs: no rows are kept beside the passes, small results leave the dictionary in place."""

from conftest import SMALL
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.operators import rdf as RD
from sensorweave.operators.triple_store import TripleStore
from sensorweave.plans import rdf_queries as Q


def _list_triples():
    return [("_:a", RD.RDF_REST, "_:b"), ("_:a", RD.RDF_FIRST, "_:i"), ("_:b", RD.RDF_REST, RD.RDF_NIL), ("_:b", RD.RDF_FIRST, "_:j"),
            ("_:i", RD.MIN_INCL, "1.5"), ("_:a", RD.RDF_TYPE, "http://x.y/z#T"), ("_:not a node", "http://p/1", "_:no node")]


def test_building_keeps_no_rows(spark, monkeypatch):
    """Rows kept between the two passes fill the executors' memory, and the passes then spill."""
    def kept(self, *_):
        raise AssertionError("rows are kept")
    monkeypatch.setattr(DataFrame, "persist", kept)
    monkeypatch.setattr(DataFrame, "cache", kept)
    store = TripleStore.build(spark.createDataFrame(_list_triples(), "s string, p string, o string"))
    assert sorted(map(tuple, store.decode(store.pred(RD.RDF_FIRST), "s", "o").collect())) == [("_:a", "_:i"), ("_:b", "_:j")]
    assert [r["o"] for r in store.text("http://p/1").collect()] == ["_:no node"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_local_names_leave_the_dictionary_in_place(spark, monkeypatch):
    store = TripleStore.build(spark.createDataFrame(_list_triples(), "s string, p string, o string"))
    monkeypatch.setattr(Q, "triple_store", lambda *_: store)
    got = Q.rdf_local_name(spark, "")
    assert {r["local_name"] for r in got.collect()} == {"rest", "first", "minInclusive", "type", "T", "http://p/1"}
    # the few ids are a stored table of known size, which is broadcast from the first plan on
    found = Q.RD._cut(spark.createDataFrame([(1,)], "iri long"))
    plan = store.decode(found, "iri")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    sides = got._jdf.queryExecution().optimizedPlan().toString()
    assert "/round-" in sides or "round-" in str(got.inputFiles())


def test_line_items_are_numbered_once(spark):
    """The triples of all kinds come from one scan of the line items, and from stored rows where they are read again."""
    plans = [Q.triples(spark, SMALL, *again)._jdf.queryExecution().executedPlan().toString() for again in ((), (True,))]
    assert [p.count("lineitem.parquet") for p in plans] == [1, 0]


def test_large_results_are_decoded_alike(spark):
    store = TripleStore.build(spark.createDataFrame(_list_triples(), "s string, p string, o string"))
    ids = store.pred(RD.RDF_FIRST).unionByName(store.pred(RD.RDF_FIRST))
    assert sorted(map(tuple, store.decode(ids, "s", "o", large=True).collect())) == sorted(map(tuple, store.decode(ids, "s", "o").collect()))


def test_ntriples_text_is_written_compressed(spark, tmp_path, monkeypatch):
    rows = [(f"http://a.b/s{i}", "http://a.b/p", f"say \"{i}\"\n") for i in range(50)]
    monkeypatch.setattr(Q, "triples", lambda *_: spark.createDataFrame(rows, "s string, p string, o string"))
    got = Q.rdf_triples(spark, "")
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert got.inputFiles() and all(f.endswith(".gz") for f in got.inputFiles())
    assert got.filter(F.col("p") == "http://a.b/p").count() == 50
