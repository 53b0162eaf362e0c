"""The dictionary-encoded triples give what the string triples give, also where hashes collide."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.operators import rdf as RD
from sensorweave.operators.triple_store import TripleStore, hash_id
from sensorweave.plans import rdf_queries as Q


def weak(term, attempt=0):
    """Few different hashes at the first attempt."""
    return F.pmod(F.xxhash64(term), F.lit(40)).cast("long") if not attempt else F.pmod(hash_id(term, attempt), F.lit(100_000))


@pytest.mark.parametrize("hash_fn", [hash_id, weak])
def test_same_results_as_on_strings(spark, hash_fn):
    t = Q.triples(spark, SMALL).filter("s not like '_:%' or cast(regexp_extract(s, '[0-9]+', 0) as bigint) < 60").persist()
    store = TripleStore.build(t, hash_fn=hash_fn)
    assert bool(store.spare) == (hash_fn is weak)
    terms = store.terms.collect()
    assert len({r["id"] for r in terms}) == len({r["term"] for r in terms}) == len(terms)
    heads = RD.pred(t, RD.WITH_RESTRICTIONS, "range", "head").select("head")
    want = sorted(map(tuple, RD.list_items(t, heads).collect()))
    on_ids = store.decode(RD.list_items(store, RD.pred(store, RD.WITH_RESTRICTIONS, "range", "head").select("head")), "head", "item")
    assert sorted(map(tuple, on_ids.collect())) == want and want
    for strict in (False, True):
        plain = RD.fold_constraints(RD.restriction_ranges(t, strict)).collect()
        for got in ([RD.property_ranges(t)] if hash_fn is hash_id and not strict else []) + [RD.property_ranges(store, strict)]:
            assert sorted(map(str, got.collect())) == sorted(map(str, plain))


def test_literals_stay_beside_nodes_of_one_text(spark):
    rows = [("http://a.b/x", "http://p/1", "http://a.b/y", "literal"), ("http://a.b/x", "http://p/1", "http://a.b/y", "iri"),
            ("_:b", "http://p/1", "7", "literal")]
    store = TripleStore.build(spark.createDataFrame(rows, "s string, p string, o string, o_kind string"))
    assert [r["o"] for r in store.decode(store.pred("http://p/1"), "s", "o").collect()] == ["http://a.b/y"]
    assert sorted(r["o"] for r in store.text("http://p/1").collect()) == ["7", "http://a.b/y"]


def test_ids_are_joined_not_terms(spark):
    """The pattern reads two columns of longs of one predicate's partition."""
    store = Q.triple_store(spark, SMALL)
    plan = store.pred(RD.RDF_REST)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:bigint,o:bigint>" in plan and "PartitionFilters: [isnotnull(p" in plan


def test_stores_follow_the_tables(spark, tmp_path):
    """A changed table is a new state, so nothing stored from the old one is read."""
    from sensorweave.sources.tables import tables_state
    path = f"{tmp_path}/events.parquet"
    spark.range(3).write.parquet(path)
    before = tables_state(spark, str(tmp_path), ["events"])
    assert before == tables_state(spark, str(tmp_path), ["events"])
    spark.range(4).write.mode("overwrite").parquet(path)
    assert before != tables_state(spark, str(tmp_path), ["events"])


def test_numbering_by_both_ways(spark):
    from sensorweave.operators.ranking import numbered
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.choice([1, 1, 2, 3]), i, rng.random()) for i in range(300)], "g int, i int, x double")
    a, b = numbered(df, ["g"], ["x"]), numbered(df, ["g"], ["x"], most=10)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    # ranks and group sizes come from one pass over the sorted rows
    assert str(a._jdf.queryExecution().optimizedPlan().toString()).count("Window [") == 1
