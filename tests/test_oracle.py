"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from conftest import SMALL
from helpers import duck_rows, spark_rows
from sensorweave.plans.proxy import telemetry

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    got = spark_rows(df)
    cols, want = duck_rows(duck, ORACLES[key])
    assert sorted(df.columns) == cols
    assert len(got) == len(want)
    assert got == want


def test_batch_metrics_rows(spark):
    m = QUERIES["batch_metrics"](spark, SMALL).collect()
    assert len(m) >= 1
    assert sum(r["records"] for r in m) == telemetry(spark, SMALL).count()
    assert all(r["seconds"] > 0 for r in m)
