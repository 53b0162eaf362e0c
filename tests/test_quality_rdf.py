"""Constraints, clamp, RDF operators - properties and brute-force checks."""

import random

import pytest

from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.functions import fixed
from sensorweave.operators import patterns as PT
from sensorweave.operators import rdf as RD
from sensorweave.plans import quality_queries as Q
from sensorweave.plans.proxy import telemetry
from sensorweave.plans.rdf_queries import kb_triples
from sensorweave.session import scratch_path


def test_kb_extraction_strict_is_empty_and_relaxed_finds_six(spark):
    kb = kb_triples(spark)
    assert RD.fold_constraints(RD.restriction_ranges(kb, strict=True)).count() == 0
    got = {r["property"]: (r["min"], r["max"])
           for r in RD.fold_constraints(RD.restriction_ranges(kb)).collect()}
    assert got["hasJointAngle"] == (-360.0, 360.0)   # U+2212 minus read as '-'
    assert got["hasCurrent"] == (2.5, 25.0)
    assert len(got) == 6


def test_clamp_stays_in_range_and_leaves_no_violation(spark):
    tel = telemetry(spark, SMALL)
    limits = Q.kb_limits(spark)
    assert limits == fixed.DEFAULT_LIMITS
    stated = RD.fold_constraints(RD.restriction_ranges(kb_triples(spark)))
    clamped = Q.clamp_columns(tel, limits)
    # clamping is wider than the stated range for force and torque alone: only values below zero remain
    left = Q.violations(clamped, stated).select("property", (F.col("value") < 0).alias("below")).distinct().collect()
    assert Q.violations(tel, stated).count() > Q.violations(clamped, stated).count()
    assert {r.property for r in left} <= {"hasForce", "hasTorque"} and all(r.below for r in left)
    for p, cols in fixed.PROPERTY_COLUMNS.items():
        lo, hi = limits[p]
        for c in cols:
            assert clamped.filter((F.col(c) < lo) | (F.col(c) > hi)).count() == 0


def test_ntriples_round_trip(spark):
    t = spark.createDataFrame([("http://a#x", "http://b#p", 'say "hi"'), ("_:b1", "http://b#q", "http://c#o"),
                               ("http://a#y", "http://b#p", "−360")], "s string, p string, o string")
    path = scratch_path(spark, "test-nt")
    RD.to_ntriples(t).write.text(path)
    back = RD.read_ntriples(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))


def test_ntriples_awkward_literals_and_rejects(spark):
    rows = [("http://a#x", "http://b#p", t, "literal") for t in (
        "line\nbreak\r\ttab", "note: text", "http://looks/like#iri", "back\\nslash \\\\ \"q\"", "_:notblank", "")]
    rows += [("_:b", "http://b#p", "http://c#o", "iri"), ("http://a#x", "http://b#p", "_:b", "blank")]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    path = scratch_path(spark, "test-nt2")
    RD.to_ntriples(t).write.text(path)
    assert sorted(map(tuple, RD.read_ntriples(spark, path, kinds=True).collect())) == sorted(rows)
    spark.createDataFrame([("not a triple",), ("# comment",), ("",)], "value string").write.mode("append").text(path)
    assert [r.value for r in RD.ntriples_rejects(spark, path).collect()] == ["not a triple"]
    assert RD.read_ntriples(spark, path).count() == len(rows)


def _triples(spark, rest):
    nodes = {a for a, _ in rest}
    rows = [(a, RD.RDF_REST, b) for a, b in rest] + [(n, RD.RDF_FIRST, "i" + n) for n in nodes]
    return spark.createDataFrame(rows, "s string, p string, o string")


def test_list_items_match_a_walk(spark):
    """Lists of many lengths, one long one, shared tails, interior heads and a head without any list."""
    rnd = random.Random(7)
    rest, heads = [], ["nowhere"]
    for li in range(30):
        length = rnd.randint(1, 200) if li else 1500
        nodes = [f"n{li}_{i}" for i in range(length)]
        rest += list(zip(nodes, [*nodes[1:], RD.RDF_NIL], strict=True))
        heads += [nodes[0], nodes[length // 2]]
        if li % 3 == 0:
            rest.append((f"x{li}", nodes[length // 2]))
            heads.append(f"x{li}")
    nxt = dict(rest)
    want = set()
    for h in heads:
        at, pos = h, 0
        while at in nxt:
            want.add((h, pos, "i" + at))
            at, pos = nxt[at], pos + 1
    got = RD.list_items(_triples(spark, rest), spark.createDataFrame([(h,) for h in heads], "head string")).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_a_cyclic_list_raises(spark):
    with pytest.raises(ValueError):
        RD.list_items(_triples(spark, [("a", "b"), ("b", "c"), ("c", "a")]), spark.createDataFrame([("a",)], "head string"))


def test_lists_that_part_and_meet_give_each_way(spark):
    """Nodes with two successors, links stated twice: an item for each way that leads to it."""
    rnd = random.Random(5)
    rest = [(f"n{i}", f"n{min(30, i + rnd.randint(1, 3))}") for i in range(30) for _ in range(rnd.choice([1, 1, 1, 2]))] + [("n30", RD.RDF_NIL)]
    heads, want = ["n0", "n0", "n7", "n30", "nowhere"], []
    for h in set(heads):
        at = [h] if h != "nowhere" else []
        for pos in range(len(rest)):
            want += [(h, pos, "i" + n) for n in at]
            at = [b for n in at for a, b in rest if a == n and b != RD.RDF_NIL]
    got = RD.list_items(_triples(spark, rest), spark.createDataFrame([(h,) for h in heads], "head string")).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_lists_of_one_member(spark):
    got = RD.list_items(_triples(spark, [("a", RD.RDF_NIL), ("b", RD.RDF_NIL)]), spark.createDataFrame([("a",)], "head string"))
    assert [tuple(r) for r in got.collect()] == [("a", 0, "ia")]


def test_a_round_is_one_write(spark, monkeypatch):
    """Heads, then one write for each doubling; a list of eight needs three and no round that finds nothing."""
    written, cut = [], RD._cut
    monkeypatch.setattr(RD, "_cut", lambda df, *parts: written.append(1) or cut(df, *parts))
    nodes = [f"n{i}" for i in range(8)]
    triples = _triples(spark, list(zip(nodes, [*nodes[1:], RD.RDF_NIL], strict=True)))
    assert RD.list_items(triples, spark.createDataFrame([("n0",)], "head string")).count() == 8
    assert len(written) == 4
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_large_tables_are_joined_by_hash(spark, monkeypatch):
    """Without sorting, dealt to more tasks where a task would hold too many rows; few rows go to every task."""
    rows = spark.range(300).selectExpr("id % 100 as k", "id as x")
    table = spark.range(100).selectExpr("id as k", "id * 2 as y")
    want = sorted((i % 100, i, i % 100 * 2) for i in range(300))
    for few, a_task, shown in ((1000, 1000, "BroadcastHashJoin"), (10, 1000, "ShuffledHashJoin"), (10, 5, "REPARTITION_BY_NUM")):
        monkeypatch.setattr(RD, "FEW_ROWS", few)
        monkeypatch.setattr(RD, "ROWS_A_TASK", a_task)
        got = RD.hash_join(rows, table, "k", 100)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert shown in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, got.collect())) == want


def test_nodes_are_told_from_literals_as_by_pattern(spark):
    texts = ["_:", "_:a", "_:a b", "_:a\n", "_:\n", "_: ", "_:\x0b", "_:a\tb", "_:a\r\n", "_:é", "_:\u2028", "_:\u00a0", "http://a#b", "http://a b", "a:",
             ":a", "1:2", "a:<", "", "7", "x", "a:\n", "note: text", "_:a\u0085", None]
    texts += [RD.RDF_NIL, RD.OWL_CLASS, "a:é", "a:b\u2028", "a+.-9:b", "9a:b"] + [f"a:b{chr(i)}c" for i in range(256)] + [f"a:{chr(i)}" for i in range(256)]
    df = spark.createDataFrame([(t,) for t in texts], "o string")
    o = F.col("o")
    plain = F.when(o.startswith("_:"), o.rlike(r"^_:\S+$")).otherwise(o.rlike(RD.IRI))
    assert df.filter(~RD.is_node(o).eqNullSafe(plain)).collect() == []


def test_transitive_closure_matches_brute_force(spark):
    rnd = random.Random(3)
    edges = {(a, b) for a in range(60) for b in range(a + 1, min(a + 8, 60)) if rnd.random() < 0.3}
    closure = set(edges)
    changed = True
    while changed:
        new = {(a, d) for (a, b) in closure for (c, d) in closure if b == c} - closure
        changed = bool(new)
        closure |= new
    df = spark.createDataFrame(sorted(edges), "c int, p int")
    got = {(r["c"], r["p"]) for r in RD.transitive_closure(df).collect()}
    assert got == closure


def test_paths_match_brute_force_with_cycles(spark):
    rnd = random.Random(11)
    edges = sorted({(f"v{rnd.randint(0, 7)}", f"v{rnd.randint(0, 7)}") for _ in range(18)})
    rows = [(f"e{i}", s, d, "T") for i, (s, d) in enumerate(edges)]
    expected = []

    def walk(path_edges, nodes):
        if path_edges:
            expected.append((len(path_edges), "->".join(nodes)))
        if len(path_edges) == 3:
            return
        for eid, s, d, _ in rows:
            if s == nodes[-1] and eid not in path_edges:
                walk(path_edges + [eid], nodes + [d])
    for eid, s, d, _ in rows:
        walk([eid], [s, d])
    df = spark.createDataFrame(rows, "edge_id string, src string, dst string, type string")
    got = sorted((r["hops"], r["path"]) for r in PT.paths_up_to(df, 3).collect())
    assert got == sorted(expected)


def test_rank_within_group_with_a_hot_group(spark):
    from pyspark.sql import Window
    from sensorweave.operators.ranking import rank_within_group
    rnd = random.Random(5)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 50), rnd.random(), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g int, o double, i int")
    got = rank_within_group(df, ["g"], ["o", "i"], partitions=16)
    w = Window.partitionBy("g").orderBy("o", "i")
    ref = df.select("i", F.row_number().over(w).alias("rn"), F.count("*").over(Window.partitionBy("g")).alias("n"))
    bad = got.join(ref, "i").filter((F.col("rank") != F.col("rn")) | (F.col("group_size") != F.col("n")))
    assert got.count() == 5000 and bad.count() == 0


def test_list_maxima_are_those_of_the_expanded_lists(spark):
    """Lists of many lengths with shared tails, inner heads, a tail that is led to but not stated, members without a value."""
    rnd = random.Random(11)
    rest, heads = [("e0", "e1"), ("e1", "unstated")], ["nowhere", "e0", "unstated"]
    for li, length in enumerate([1, 2, 3, 4, 5, 17, 64, 129]):
        nodes = [f"n{li}_{i}" for i in range(length)]
        rest += list(zip(nodes, [*nodes[1:], RD.RDF_NIL], strict=True))
        rest.append((f"x{li}", nodes[length // 2]))
        heads += [nodes[0], nodes[length // 2], f"x{li}"]
    triples = _triples(spark, rest)
    values = [("i" + n, rnd.choice([None, -1.0, 2.5, float(rnd.randrange(1000))])) for n, _ in rest if rnd.random() < 0.8]
    values += [(i, v + 1) for i, v in values[::7] if v is not None]
    best = {}
    for i, v in values:
        if v is not None:
            best[i] = max(v, best.get(i, v))
    head_rows = spark.createDataFrame([(h, k) for k, h in enumerate(heads)], "head string, k int")
    want = {}
    for r in RD.list_items(triples, head_rows.select("head")).collect():
        want.setdefault(r["head"], []).append(best.get(r["item"]))
    want = {h: max((v for v in vs if v is not None), default=None) for h, vs in want.items()}
    nodes = RD._cut(RD.list_nodes(triples, spark.createDataFrame(values, "item string, v double")))
    got = RD.list_maxima(nodes, head_rows).collect()
    assert {r["head"]: r["v"] for r in got} == want and "unstated" not in want
    assert len(got) == sum(h in want for h in heads)
    assert all(heads[r["k"]] == r["head"] for r in got)


def test_maxima_of_cyclic_lists(spark):
    """A head that leads into a cycle raises; a cycle that no head leads into does not."""
    triples = _triples(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("z", "b"), ("p", "q"), ("q", RD.RDF_NIL)])
    nodes = RD._cut(RD.list_nodes(triples, spark.createDataFrame([("ip", 3.0)], "item string, v double")))
    with pytest.raises(ValueError):
        RD.list_maxima(nodes, spark.createDataFrame([("z",)], "head string"))
    assert [tuple(r) for r in RD.list_maxima(nodes, spark.createDataFrame([("p",)], "head string")).collect()] == [("p", 3.0)]


def test_two_successors_are_no_list(spark):
    triples = _triples(spark, [("a", "b"), ("a", "c"), ("b", RD.RDF_NIL), ("c", RD.RDF_NIL)])
    with pytest.raises(Exception, match="two successors"):
        RD.list_nodes(triples, spark.createDataFrame([("ia", 1.0)], "item string, v double")).collect()
