import zlib

import numpy as np
import pytest
from conftest_paths import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorweave.llm import packing as K
from sensorweave.llm import queries as Q

PATH = Q.tokenizer_path()
WHOLE = Tokenizer.from_file(PATH)
WORDS = K.TextIds(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aB'sltÀßÿé0 9.,<|>\n\t\x1ć İ", max_size=40)))
def test_ids_of_any_text(text):
    assert np.frombuffer(WORDS.of(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b it's we'll", "µ ª º ŉ ǅ ﬁ ẞİ", "Ελλάς Σ ς"])
def test_ids_of_odd_texts(text):
    assert np.frombuffer(WORDS.of(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_round_trip(where, edge_dir, results, tables):
    d = edge_dir if where == "edge" else where
    texts = tables(d).execute("SELECT doc_id, text FROM documents").fetchall()
    want = []
    for doc, text in texts:
        own = [*ids(text), 0]
        want += [(doc, n, s, len(p := own[s:s + 2048]), zlib.crc32(np.array(p, "<u4").tobytes()))
                 for n, s in enumerate(range(0, len(own), 2048))]
    got = results("op4_packing", d)
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    upto = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == upto.get(r.sequence_id, 0)
        upto[r.sequence_id] = r.offset + r.length
    assert max(upto.values()) <= 2048
    assert len(upto) <= 1.01 * sum(r.length for r in got) / 2048 + 1


def test_empty(empty_dir, results):
    assert results("op4_packing", empty_dir) == []


def test_two_replace_the_smallest():
    # greedy: 60 + 30, gap 10; then 30 gives way to 21 + 19, which fill it
    assert K.fillings({60: 1, 30: 1, 21: 1, 19: 1}, 100) == [({60: 1, 21: 1, 19: 1}, 1), ({30: 1}, 1)]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25))
def test_fillings_use_every_document_once(counts):
    used, bins = {}, 0
    for bin_, n in K.fillings(counts, 50):
        assert sum(size * m for size, m in bin_.items()) <= 50
        bins += n
        for size, m in bin_.items():
            used[size] = used.get(size, 0) + m * n
    assert used == counts
    total = sum(size * n for size, n in counts.items())
    assert bins <= 2 * total / 50 + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, "a b c d e f g h")], "doc_id long, text string")
    packed = K.pack(docs, PATH, 6, ids=True).cache()
    whole = {r.sequence_id: r.ids for r in K.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert sorted(x for w in whole.values() for x in w) == sorted(x for t in ("the cat sat", "", "a b c d e f g h") for x in [*ids(t), 0])
