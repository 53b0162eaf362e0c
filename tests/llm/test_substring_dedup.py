import hashlib
import random

import numpy as np
import pytest

from sensorweave.llm import substring_dedup as S


def plain(rows, window):
    """(doc_id, n_words, n_removed, kept) by holding every window of every document."""
    first = {}
    words = [(t or b"").split() for _, t in rows]
    for (doc, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if doc is not None and doc < first.get(key, doc + 1):
                first[key] = doc
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("period", range(2, 30))
def test_cover_has_every_difference(period):
    cover = S.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_contract_cover():
    assert S.difference_cover(7) == [0, 1, 3]


def test_word_hashes_depend_on_the_word_alone(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 64)
    rng = random.Random(3)
    words = [bytes(rng.choices(b"ab\xc3\xa9z", k=rng.choice([1, 2, 3, 40, 63, 64, 65, 70, 300]))) for _ in range(400)]
    text = b"".join(w + bytes(rng.choices(S.BLANKS, k=rng.randint(1, 3))) for w in words)
    start, end, h = S.Words().of(text)
    assert [text[a:b] for a, b in zip(start, end, strict=True)] == words
    by_word = {}
    for w, x in zip(words, h.tolist(), strict=True):
        by_word.setdefault(w, set()).add(x)
    assert all(len(x) == 1 for x in by_word.values())
    assert len({x for v in by_word.values() for x in v}) == len(by_word)


@pytest.mark.parametrize("text", [b"", b" \n", b"a", b" a\x0bb ", b"x" * 1000])
def test_words_of_small_texts(text):
    start, end, h = S.Words().of(text)
    assert [text[a:b] for a, b in zip(start, end, strict=True)] == text.split() and len(h) == len(start)


@pytest.mark.parametrize(("window", "period", "seed"), [(13, 7, 1), (13, 7, 2), (5, 3, 3), (8, 4, 4)])
def test_brute_force(spark, monkeypatch, window, period, seed):
    """Passages at all offsets, copies, near copies, repeated and missing ids, over many small blocks and ranges."""
    monkeypatch.setattr(S, "BLOCK_BYTES", 900)
    monkeypatch.setattr(S, "RANGE_BYTES", 700)
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for doc in range(90):
        text = []
        for _ in range(rng.randint(0, 3)):
            text += [f"{doc}.{rng.random()}" for _ in range(rng.randint(0, 9))]
            text += rng.choice(passages)[rng.randint(0, 2):]
        rows.append((rng.choice([doc, doc, doc - 200, 7, None]), " ".join(text).encode()))
    rows += [(rng.randint(-50, 300), rows[3][1]) for _ in range(15)] + [(400, None), (None, None), rows[5], rows[5]]
    df = spark.createDataFrame([(d, None if t is None else t.decode()) for d, t in rows], "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept"])) for r in S.remove_repeats(df, window, period).collect()]
    assert sorted(got, key=str) == plain(rows, window)
    assert sum(g[2] for g in got) > 100


def test_edges(edge_dir, results, tables):
    rows = [(d, None if t is None else t.encode()) for d, t in tables(edge_dir).execute("SELECT doc_id, text FROM documents").fetchall()]
    want = [(d, n, gone, hashlib.sha256(kept).hexdigest()) for d, n, gone, kept in plain(rows, 13)]
    assert sorted([tuple(r) for r in results("op12_substring_dedup", edge_dir)], key=str) == sorted(want, key=str)


def test_bits_that_do_not_fit_are_an_error():
    with pytest.raises(ValueError, match="do not fit"):
        S._marks(np.arange(20, dtype=np.uint64), 4, [{"range": 0, "bits": b"\0"}])


def test_blocks_are_not_shuffled(spark):
    """Above the stored blocks no exchange stands, whatever comes back to them."""
    docs = spark.createDataFrame([(i, f"word{i} " * 20) for i in range(40)], "doc_id long, text string").repartition(4)
    blocks = S.stored_blocks(docs)
    bits = spark.createDataFrame([(0, 0, 0, b"\0")], S.BITS)
    plan = S._answers(blocks, {"texts": bits})._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("ShuffledHashJoin"):]
    scan = left.index("FileScan parquet")
    assert left[:scan].count("Exchange") == 0 and "Bucketed: true" in left
