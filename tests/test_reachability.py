"""Interval labels, path counts, ordered files and merged sketches, against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from sensorweave.operators import patterns as PT
from sensorweave.operators import reachability as RC
from sensorweave.operators.rdf import transitive_closure
from sensorweave.session import scratch_path
from sensorweave.sinks.tables import write_ordered_csv
from sensorweave.sources.files import read_csv_in_order


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "c long, p long")


@pytest.mark.parametrize(("n", "more"), [(60, 0), (60, 12), (25, 25)])
def test_labels_give_the_closure(spark, n, more):
    """Several roots, a parent of many, and nodes with parents in other trees (``more`` extra edges)."""
    rng = random.Random(n + more)
    edges = {(i, rng.choice([0, max(0, i - 1), rng.randrange(i)])) for i in range(3, n)}
    edges |= {(i, rng.randrange(i)) for i in rng.sample(range(3, n), min(more, n - 3))}
    df = frame(spark, sorted(edges))
    got = RC.below(*RC.label(df)).collect()
    want = {(r["c"], r["p"]) for r in transitive_closure(df).collect()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_range_test_of_given_pairs(spark):
    labels, extra = RC.label(frame(spark, [(1, 0), (2, 0), (3, 1), (4, 3), (6, 5)]))
    pairs = spark.createDataFrame([(4, 0), (4, 1), (4, 2), (0, 4), (3, 3), (6, 5), (6, 0), (9, 0)], "node long, above long")
    got = {(r["node"], r["above"]): r["below"] for r in RC.is_below(pairs, labels).collect()}
    assert extra.isEmpty() and {k for k, v in got.items() if v} == {(4, 0), (4, 1), (6, 5)} and len(got) == 8


def test_cycle_is_an_error(spark):
    with pytest.raises(ValueError, match="cycle"):
        RC.label(frame(spark, [(1, 2), (2, 3), (3, 1), (5, 4)]))


def test_within_is_the_range_join(spark):
    rng = random.Random(2)
    points = [(i, rng.randint(0, 70)) for i in range(80)]
    spans = [(i, *sorted(rng.choices(range(71), k=2))) for i in range(60)] + [(90, 0, 70), (91, 5, 5), (92, 9, 8)]
    got = RC.within(spark.createDataFrame(points, "i long, at long"), spark.createDataFrame(spans, "s long, lo long, hi long"), 70)
    assert Counter((r["i"], r["s"]) for r in got.collect()) == Counter((i, s) for i, at in points for s, lo, hi in spans if lo <= at <= hi)


def listed(edges):
    out = Counter()
    e = list(enumerate(edges))
    for i, (a, b) in e:
        out[1, a, b] += 1
        for j, (c, d) in e:
            if b == c and i != j:
                out[2, a, d] += 1
                for k, (x, y) in e:
                    if d == x and k not in (i, j):
                        out[3, a, y] += 1
    return out


@pytest.mark.parametrize("bound", [1, 10_000_000])
def test_path_counts_are_the_listed_paths(spark, bound):
    """Parallel edges, loops, edges back, and with a bound of one row every middle node is salted."""
    rng = random.Random(3)
    edges = [(rng.randrange(7), rng.randrange(7)) for _ in range(30)] + [(1, 1), (1, 1), (2, 2), (1, 2), (2, 1)]
    got = PT.path_counts(spark.createDataFrame(edges, "src long, dst long"), bound)
    assert Counter({(r["hops"], r["start"], r["end"]): r["n"] for r in got.collect()}) == listed(edges)


def test_path_counts_through_a_hub(spark):
    """100 000 edges into one node and 3 out of it: 300 000 pairs, salted, and no path is listed."""
    n = 100_000
    into = spark.range(n).select((F.col("id") + 10).alias("src"), F.lit(1).cast("long").alias("dst"))
    out = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (2, 5), (3, 5), (4, 5)], "src long, dst long")
    got = PT.path_counts(into.unionByName(out), bound=50_000)
    assert {(r["hops"], r["rows"], r["paths"]) for r in got.groupBy("hops").agg(F.count("*").alias("rows"), F.sum("n").alias("paths")).collect()} == {
        (1, n + 6, n + 6), (2, 3 * n + 1, 3 * n + 3), (3, n, 3 * n)}


def test_positions_follow_the_files(spark):
    path = scratch_path(spark, "test-csv")
    rows = [(random.Random(i).randint(0, 10**6), f'text "{i}", and more') for i in range(500)]
    write_ordered_csv(spark.createDataFrame(rows, "x long, t string").repartition(7), path, ["x", "t"])
    for split in ("200", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = sorted((r["position"], int(r["x"]), r["t"]) for r in read_csv_in_order(spark, path).collect())
        assert got == [(i, *r) for i, r in enumerate(sorted(rows), 1)]
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sketches_merge_within_their_error(spark):
    from sensorweave.plans.reports import SKETCH_BITS, minute_sketches, rolled_up
    links = spark.range(200_000).select((F.col("id") % 50_000).cast("string").alias("ln_name"),
                                        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5_000).cast("timestamp_ntz").alias("ln_timestamp"))
    minutes = minute_sketches(links).persist()
    day = rolled_up(minutes, "day").agg(F.sum("estimate")).first()[0]
    assert abs(day - 50_000) <= 50_000 * 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
    assert minutes.agg(F.sum("exact")).first()[0] == 50_000


def test_without_the_filter_the_seeded_report_has_the_seed_instant(spark):
    from sensorweave.functions import fixed
    from sensorweave.plans import graph_build as GB
    from sensorweave.plans import reports as R
    seen = []
    real = R.joint_position
    R.joint_position = lambda spark, tg, joint: seen.append(tg) or real(spark, tg, joint)
    try:
        out = R.report_joint_position_seeded(spark, SMALL)
    finally:
        R.joint_position = real
    assert isinstance(seen[0], GB.TelemetryGraph)
    at = F.lit(fixed.SEED_TIMESTAMP).cast("timestamp_ntz")
    assert seen[0].has_sensor.filter((F.col("joint_name") == "joint_1") & (F.col("sensor_timestamp") == at)).count() == 1
    assert out.filter(F.col("timestamp") == at).isEmpty() and not out.isEmpty()
