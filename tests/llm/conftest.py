import os
import sys

import duckdb
import pytest
from pyspark.sql import Row

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
LONG = " ".join(f"w{i % 977} the" for i in range(60_000))
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, fp long, size string, key int, row string, "
        "shard string, target long, weight string, n string, part string, words string, kept string, score string")
PLAIN = "The quick brown fox jumps over the lazy dog near the river bank while seven hens sleep."


def edge_rows():
    texts = [PLAIN, PLAIN, PLAIN.upper(), "", " \n\t ", None, "12345 !!! 67", "é ü ß ñ Ω 你好 😀 á",
             "mail a.b@c.example.com and a@b.cd_x@y.z or 1.2.3.4.5.6.7.8 +1 (555) 010-9999 4111 1111 1111 1111",
             "Released under the MIT License. Apache License, Version 2.0 CC BY-NC 4.0 <|endoftext|> it's 'll", LONG, LONG + " end",
             "one\ntwo\none\n\ntwo\nthree three three three three", "x" * 50_000, "+" * 3000 + "9" * 6000 + "@" * 50]
    rows = [Row(i, t, ("en", "de", None)[i % 3], ("a", "b", None, "a")[i % 4], None if t is None else len(t),
                i, "s", i, "r", "x", 1, "w", "n", "p", "q", "k", "z") for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[3], Row(None, PLAIN, None, None, None, *rows[0][5:]), Row(None, None, None, None, None, *rows[0][5:])]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """Tables with nulls, empty and very long texts, ties, repeated rows and columns of clashing names."""
    d = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_rows(), DOCS).coalesce(3).write.parquet(f"{d}/documents.parquet")
    labels = [(i, (None, 0, 1)[i % 3], 0, i) for i in range(14)] + [(None, 1, 0, 0), (1, 1, 0, 0), (1, 0, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, f int").write.parquet(f"{d}/labels.parquet")
    vectors = [(i, [float((i * j) % 7 - 3) for j in range(64)], 1, (i * i) % 5) for i in range(205)]
    vectors += [(300, None, 1, 1), (400, [], 1, 1), (500, [float("nan"), None] + [1.0] * 62, 1, 2), (None, [1.0] * 64, 1, 1),
                (100, [2.0] * 64, 1, 3), (600, [0.5] * 64, 1, None), (700, [-0.5] * 32, 1, 3), (800, [float("inf")] * 64, 1, 3),
                (900, [3.0e4] * 64, 1, 4), (901, [-3.0e4] * 63 + [1.0], 1, 2), (902, [0.0] * 64, 1, 2), (200, vectors[200][1], 1, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, code int, label int").coalesce(2).write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for table, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                          ("labels", "doc_id long, quality int, toxic int"),
                          ("embeddings", "vec_id long, embedding array<float>, label int")):
        spark.createDataFrame([], schema).write.parquet(f"{d}/{table}.parquet")
    return d


@pytest.fixture(scope="session")
def tables():
    """Rows of a folder's table as Python tuples, and a DuckDB connection on it."""
    def read(d):
        con = duckdb.connect()
        for t in ("documents", "labels", "embeddings"):
            p = f"{d}/{t}.parquet"
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
        return con
    return read


@pytest.fixture(scope="session")
def results(spark):
    """Rows of a registered query on a folder, computed once."""
    from sensorweave.llm import queries
    held = {}

    def run(name, d):
        if (name, d) not in held:
            df = queries.QUERIES[name](spark, d)
            held[name, d] = df.columns, df.collect()
        return held[name, d][1]
    return run
