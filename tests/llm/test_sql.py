"""Operators with a SQL form, on the edge cases and on a small table."""

import pytest
from conftest_paths import SMALL
from helpers import duck_rows, spark_rows

from sensorweave.llm import queries as Q


@pytest.mark.parametrize("where", ["edge", "empty", SMALL])
@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name, where, edge_dir, empty_dir, tables):
    d = {"edge": edge_dir, "empty": empty_dir}.get(where, where)
    df = Q.QUERIES[name](spark, d)
    cols, want = duck_rows(tables(d), Q.ORACLES[name])
    assert sorted(df.columns) == cols
    assert spark_rows(df) == want


@pytest.mark.parametrize("name", ["op5_quality_rules", "op7_mixing"])
def test_no_python_on_the_main_path(spark, name):
    plan = Q.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_mix_repeats_and_targets(spark):
    rows = Q.QUERIES["op7_mixing"](spark, SMALL).toPandas()
    assert (rows["taken"] <= 3 * rows["size"]).all()
    again = Q.QUERIES["op7_mixing"](spark, SMALL).toPandas()
    assert rows.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert rows["taken"].sum() <= rows["size"].sum() < rows["taken"].sum() + 20_000
