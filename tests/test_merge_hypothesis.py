"""Property: a first-wins merge does not depend on how rows are split into batches
or on their order, as long as each key's rows arrive in one batch (a time-ordered
topic gives this for the event timestamp)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from sensorweave.operators import graph as G

rows_st = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 10_000), st.text(max_size=3)),
                   min_size=1, max_size=40, unique_by=lambda r: r[1])


@settings(max_examples=15, deadline=None)
@given(rows=rows_st, cut=st.integers(0, 5), reverse=st.booleans())
def test_first_wins_is_batch_and_order_insensitive(spark, rows, cut, reverse):
    schema = "k int, o int, v string"
    whole = G.first_per_key(spark.createDataFrame(rows, schema), ["k"], "o")
    a = [r for r in rows if r[0] <= cut]
    b = [r for r in rows if r[0] > cut]
    if reverse:
        a, b = b[::-1], a[::-1]
    t = G.merge_insert(spark.createDataFrame(a, schema), None, ["k"], "o")
    t = G.merge_insert(spark.createDataFrame(b, schema), t, ["k"], "o")
    assert sorted(map(tuple, t.collect())) == sorted(map(tuple, whole.collect()))
    expected = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        expected.setdefault(k, (k, o, v))
    assert sorted(map(tuple, whole.select("k", "o", "v").collect())) == sorted(expected.values())
