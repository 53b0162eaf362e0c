"""The pipeline's stages against brute force, on the edge cases and on a small table."""

import pytest
from conftest_paths import SMALL
from test_simhash import plain_components

import corpus_pipeline as P
from sensorweave.llm import mixing
from sensorweave.llm.common import cut


def test_stages():
    assert [n for n, _ in P.STAGES] == ["language", "simhash", "personal_data", "mixing", "packing"]


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_each_stage(spark, where, edge_dir):
    d = edge_dir if where == "edge" else where
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, before = docs.columns, docs.collect()

    docs = cut(P.language(spark, docs, d), "t")
    after = docs.collect()
    assert docs.columns == columns
    lettered = {r.text for r in before if any(c.isalpha() for c in r.text or "")}
    assert {r.text for r in after} <= lettered and (where == "edge" or len({r.text for r in after}) == len(lettered))
    assert all(r.lang for r in after)

    kept = cut(P.near_duplicates(spark, docs, d), "t")
    assert kept.columns == columns
    short = [r for r in after if len(r.text) < 100_000]
    want = {c for _, _, c in plain_components([(r.doc_id, r.text) for r in short])}
    assert want == {r.doc_id for r in kept.collect() if len(r.text) < 100_000}

    clean = cut(P.personal_data(spark, kept, d), "t")
    assert clean.columns == columns and clean.count() == kept.count()
    assert all(r.n_chars == len(r.text) and "@" not in r.text.replace("@" * 50, "") for r in clean.collect())

    mixed = cut(P.mix_sources(spark, clean, d), "t")
    sizes = clean.select("doc_id", "source", mixing.word_count(clean["text"]).alias("size"))
    copies = {r.doc_id: r.copies for r in mixing.mix(sizes).collect()}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert mixed.columns == columns and got == {k: v for k, v in copies.items() if v}

    packed = P.pack_sequences(spark, mixed, d)
    pieces = packed.filter("piece = 0").count()
    assert pieces == mixed.count()


def test_run_on_empty_tables(spark, empty_dir):
    assert P.run(spark, empty_dir).count() == 0


def test_run(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"](spark, SMALL).count() > 0 and "pipeline" not in E.oracle_sql()
