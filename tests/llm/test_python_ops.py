"""Operators without a SQL form, against brute force on the edge cases and on a small table."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest_paths import MEDIUM, SMALL

from sensorweave.llm import hamming_search, langid, license_scan, quality_model, sanitise, sharding

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def folder(where, edge_dir):
    return edge_dir if where == "edge" else where


def digits(s):
    return re.sub("[^0-9]", "", s)


def plain_luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(s))) % 10 == 0


def plain_spans(text):
    text = text or ""
    return [*(("email", *m.span()) for m in EMAIL.finditer(text)),
            *(("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))),
            *(("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and plain_luhn(digits(m.group()))),
            *(("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15)]


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_pii_spans(where, edge_dir, results, tables):
    d = folder(where, edge_dir)
    rows = tables(d).execute("SELECT doc_id, text FROM documents").fetchall()
    rows = [r for r in rows if len(r[1] or "") < 5000 or len(r[1]) > 60_000]  # the plain patterns are quadratic on one edge case
    want = []
    for doc, text in rows:
        spans = plain_spans(text)
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        want.append((doc, *(sum(k == kind for k, _, _ in spans) for kind in sanitise.KINDS), hashlib.sha256(said.encode()).hexdigest(), said))
    got = [(*tuple(r)[:6], ",".join(x for x in r.spans.split(",") if not x.startswith("term"))) for r in results("op3_pii", d)]
    assert set(map(str, want)) <= set(map(str, got)) and len(got) >= len(want)


@pytest.mark.parametrize("text", ["a@b.c@d.e", "a@b.cd_x@y.z", "x@y", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.4", "1.2.3.",
                                  "+1-2", "+1 (555) 010-9999", "4111-1111 1111 1111", "4111  1111 1111 1111", "0" * 13, "a" * 50 + "@" * 5])
def test_pii_patterns(text):
    assert sanitise.base_spans(text) == plain_spans(text)


def test_disclosing_terms(spark, tmp_path):
    """A word that stands only with one address is removed, one that mostly does is generalised, common ones stay."""
    rows = [f"report {i} from agent quillfeather about item {i} mail boss@corp.example.com now" for i in range(8)]
    rows += [f"the note {i} of agent smith about item {i} and nothing else" for i in range(4000)]
    rows += [f"quiet place {i} of sparrowhawk" for i in range(4)]
    rows += [f"sparrowhawk {i} writes to boss@corp.example.com daily" for i in range(4)]
    rows += ["copied plumtree by boss@corp.example.com"] * 50  # copies are one observation
    d = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, "keep") for i, t in enumerate(rows)], "doc_id long, text string, spans string").write.parquet(d)
    out = {r.doc_id: r for r in sanitise.sanitise(spark.read.parquet(d)).collect()}
    assert len(out) == len(rows) and all(r.spans == "keep" for r in out.values())
    assert "quillfeather" not in out[0].text and "boss@" not in out[0].text and "[email]" in out[0].text and "agent" in out[0].text
    at = 8 + 4000
    assert out[at].text == rows[at] and out[20].text == rows[20]  # no entity: untouched
    assert out[at + 6].text.startswith("[term]")
    assert "plumtree" in out[len(rows) - 1].text


def sanitised(spark, tmp_path, texts):
    d = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(d)
    return [r.text for r in sanitise.sanitise(spark.read.parquet(d)).orderBy("doc_id").collect()]


def test_a_line_shared_by_different_texts_counts_in_each(spark, tmp_path):
    texts = [f"letter about matter {i}\nquillfeather boss@corp.example.com" for i in range(6)]  # the same signature
    texts += [f"sparrowhawk wrote note {i} for rare@corp.example.com" for i in range(2)]  # an address seen twice
    texts += ["plumtree by once@corp.example.com"] * 5  # copies of a whole text
    texts += [f"note {i} about nothing else" for i in range(2000)]
    out = sanitised(spark, tmp_path, texts)
    assert not any("quillfeather" in t for t in out[:6])
    assert not any("sparrowhawk" in t for t in out[6:8]) and all("note" in t for t in out[6:8])
    assert all("plumtree" in t for t in out[8:13]) and out[13:] == texts[13:]


def test_proven_terms_are_hidden_in_the_whole_text(spark, tmp_path):
    """Across lines, beyond fixed blocks of words, far from the entity, and names of one or two characters."""
    far = " ".join(f"the{k}" for k in range(200))
    texts = [f"Quillfeather boss@corp.example.com\nof report {i}\n{far}\nQuillfeather phoned (Quillfeather!)" for i in range(4)]
    texts += [f"head@corp.example.com\nSparrowhawk {i}" for i in range(4)]  # only ever in the next line
    texts += [" ".join(f"the{k}" for k in range(31)) + f" desk@corp.example.com Plumtree {i}" for i in range(4)]  # words 32 and 33
    texts += [f"Li wrote for wu@corp.example.com, said 李明 and Q in {i}" for i in range(4)]
    texts += [f"{far} note {i} in of wrote for and said report" for i in range(2000)]
    texts += ["Quillfeather and sparrowhawk without an address"]
    out = sanitised(spark, tmp_path, texts)
    for t in out[:16]:
        assert "@" not in t and not set(re.findall(r"\w+", t.lower())) & {"quillfeather", "sparrowhawk", "plumtree", "li", "李明", "q"}
    assert all("report" in t and far in t for t in out[:4]) and out[16:] == texts[16:]


def test_context_of_many_entities_stays_linear():
    text = " ".join(f"name{i} a{i}@b.example.com" for i in range(3000))
    pairs = sanitise.beside(text, sanitise.base_spans(text))
    assert len(pairs) <= 2 * sanitise.CONTEXT_WORDS * 3000 and len({e for e, _ in pairs}) == 3000


def test_sanitise_keeps_every_row(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = sanitise.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_shards(where, edge_dir, results, tables):
    d = folder(where, edge_dir)
    rows = tables(d).execute("SELECT doc_id, text FROM documents").fetchall()
    got = results("op6_sharding", d)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=str)
    slots = {}
    for r in got:
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_balanced_and_groups_whole(results, tables):
    got = results("op6_sharding", MEDIUM)
    texts = dict(tables(MEDIUM).execute("SELECT doc_id, text FROM documents").fetchall())
    size, of = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
        of.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert max(size.values()) <= 1.02 * sum(size.values()) / 40 and len(size) == 40
    assert all(len(s) == 1 for s in of.values())


def test_placement_follows_the_dot_product():
    # equally open in bytes: the unit with many rows goes where rows are open
    room = np.array([[100.0, 50, 10], [100, 50, 30]])
    assert sharding.place(np.array([[10.0, 5, 5]]), room, 0).tolist() == [1]


def test_large_groups_of_copies_are_cut(spark):
    rows = [(i, "same text " * 20) for i in range(3000)] + [(3000 + i, f"own text {i} " * 5) for i in range(6000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 40)
    size = {r["shard"]: r["sum(size)"] for r in got.groupBy("shard").sum("size").collect()}
    assert len(size) == 40 and max(size.values()) <= 1.05 * sum(size.values()) / 40


def test_language_held_out(results, tables):
    want = dict(tables(MEDIUM).execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = results("op8_langid", MEDIUM)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == len(want)
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(edge_dir, results, tables):
    for doc, text in tables(edge_dir).execute("SELECT doc_id, text FROM documents WHERE doc_id IS NOT NULL").fetchall():
        rows = [r for r in results("op8_langid", edge_dir) if r.doc_id == doc]
        none = not any(c.isalpha() for c in text or "")
        assert rows and all((r.lang_pred == "und") == none and (r.lang_pred in ("und", "en", "de")) for r in rows)


def test_language_of_long_texts_counts_all_of_it():
    """Slices of a long text give the trigrams of the whole."""
    text = "abc déf " * 300_000
    codes = np.concatenate([c for c, _ in langid.grams([text])])
    low = f" {text} "
    assert len(codes) == sum(low[i].isalpha() for i in range(1, len(low) - 1))


def test_language_filters_hold_every_language(spark):
    rows = [(lang, text) for lang, text in (("en", "the cat and the dog"), ("de", "der hund und die katze"), ("fr", "le chat et le chien"))
            for _ in range(5)]
    found = langid.fit(spark.createDataFrame(rows, "lang string, text string"), bits=14)
    for lang, text in rows[::5]:
        codes = np.concatenate([c for c, _ in langid.grams([text])])
        slots = langid.slots_of(codes, found.bits)
        masks = found.table[0][slots[0]] & found.table[0][slots[1]] & found.table[0][slots[2]]
        k = found.languages.index(lang)
        assert ((masks >> np.uint64(k)) & np.uint64(1)).all()
    assert found.predict(["the dog", "die katze", "le chien", "", None, "123"])[0] == ["en", "de", "fr", "und", "und", "und"]


def test_quality_held_out(results, tables):
    want = dict(tables(MEDIUM).execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in results("op9_quality_model", MEDIUM) if r.held_out and r.doc_id in want]
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_edges(edge_dir, results, tables):
    rows = results("op9_quality_model", edge_dir)
    assert len(rows) == tables(edge_dir).execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.train(x, y, rounds=20, n_pairs=1, pair_rounds=40)
    assert model.pairs == [(0, 1)]
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("values", [9, 12, 200])
def test_pair_edges_span_the_whole_list(values):
    rng = np.random.default_rng(1)
    x = rng.integers(0, values, (6000, 2)).astype(float)
    model = quality_model.train(x, (x[:, 0] > x[:, 1]).astype(float), rounds=2, n_pairs=1, pair_rounds=2)
    for c, e in zip(model.coarse, model.edges, strict=True):
        assert len(c) == quality_model.PAIR_BINS - 1 < len(e) and c[0] == e[0] and c[-1] == e[-1]


def test_additive_model_learns_an_interaction_of_upper_values():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (6000, 2)).astype(float)
    top = x >= 9
    y = (top[:, 0] ^ top[:, 1]).astype(float)
    model = quality_model.train(x, y, rounds=20, n_pairs=1, pair_rounds=40)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_license_places(where, edge_dir, results, tables):
    d = folder(where, edge_dir)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = []
    for doc, text in tables(d).execute("SELECT doc_id, text FROM documents").fetchall():
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        at = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        where_ = [i for i, _ in at]
        want.append((doc, len(words), len(at), min(where_, default=None), max(where_, default=None), ",".join(sorted({x for _, x in at}))))
    got = [tuple(r)[:6] for r in results("op10_licenses", d)]
    assert sorted(got, key=str) == sorted(want, key=str)


def accepts(template, text):
    a = license_scan.compiled("x", "x", template)
    words = license_scan.words_of(text.encode())
    return a.longest(words, 0)


def test_templates():
    t = "use <<beginOptional>>of <<beginOptional>>all<<endOptional>> this<<endOptional>> software by <<var;name=who;words=1-3>> is free"
    assert accepts(t, "Use software by ACME is free.") == 6
    assert accepts(t, "use of all this software by a b c is free today") == 11
    assert accepts(t, "use of this software, by: a b is FREE") == 9
    assert accepts(t, "use of all software by a is free") == -1  # the inner optional region needs the outer one
    assert accepts(t, "use software by a b c d is free") == -1  # four words in place of three
    assert accepts(t, "use software by is free") == -1
    assert accepts(t, "use software by a is not free") == -1
    for bad in ("<<endOptional>> a", "<<beginOptional>> a", "<<what>> a", "<<var;name=x;words=1-2>> a", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            license_scan.compiled("x", "x", bad)


def test_every_template_is_found():
    scanner = license_scan.Scanner()
    for label, needs, template in license_scan.TEMPLATES:
        plain = re.sub(r"<<var;.*?words=(\d+)-\d+>>", lambda m: " thing" * int(m.group(1)), template)
        plain = re.sub(r"<<beginOptional>>.*?<<endOptional>>", " ", plain)
        assert needs in plain.lower()
        assert label in {x for x, _, _ in scanner.scan(f"Before. {plain}, after.".encode())[2]}


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_license_texts_match_as_a_whole():
    def labels(text):
        return {x for x, _, _ in license_scan.Scanner().scan(text.encode())[2]}

    assert labels(MIT) == {"mit-text", "mit-opening"}
    evil = MIT.replace("THE SOFTWARE IS PROVIDED", "The Software shall be used for Good, not Evil.\nTHE SOFTWARE IS PROVIDED")
    assert labels(evil) == labels(MIT.replace("sell copies", "not sell copies")) == labels(MIT[:400]) == {"mit-opening"}
    parts = dict((x, re.sub("<<var.*?>>", "ACME", re.sub("<<beginOptional>>.*?<<endOptional>>", "", t))) for x, _, t in license_scan.TEMPLATES)
    for k in "234":
        assert labels(parts[f"bsd-{k}-text"]) == {f"bsd-{k}-text", "bsd-opening"}
        assert labels(parts[f"bsd-{k}-text"].replace("ARE DISCLAIMED", "ARE GIVEN")) == {"bsd-opening"}


def test_wider_vectors_are_not_cut(spark):
    def codes(width):
        rows = spark.createDataFrame([([0.0] * (width - 1) + [1.0],)], "v array<float>")
        return [r[0] for r in rows.select(hamming_search.sign_code(rows["v"])).collect()]

    assert codes(64) == [-(1 << 63)] and codes(3) == [4]
    with pytest.raises(Exception, match="more than 64 elements"):
        codes(65)


@pytest.mark.parametrize("name", ["op3_pii", "op6_sharding", "op8_langid", "op9_quality_model", "op10_licenses"])
def test_empty_tables(name, empty_dir, results):
    assert results(name, empty_dir) == []


def plain_grams(text):
    low = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    return [low[i - 1:i + 2] for i in range(1, len(low) - 1) if low[i] != " "]


def test_language_by_brute_force(results, tables):
    """Prediction and score recomputed from plain sets of n-grams; the filters' chance hits may move a score a little."""
    rows = tables(SMALL).execute("SELECT doc_id, text, lang FROM documents").fetchall()
    counts = {}
    for doc, text, lang in rows:
        if zlib.crc32(str(doc).encode()) % 3 != 1 and text is not None and lang is not None:
            own = counts.setdefault(lang, {})
            for g in plain_grams(text):
                own[g] = own.get(g, 0) + 1
    total = {k: sum(c.values()) for k, c in counts.items()}
    most = {}
    for k, c in counts.items():
        for g, n in c.items():
            most[g] = max(most.get(g, 0), n / total[k])
    has = {k: {g for g, n in c.items() if n >= 3 and 1000 * n / total[k] >= most[g]} for k, c in counts.items()}
    names = sorted(total, key=lambda k: (-total[k], k))
    for r in results("op8_langid", SMALL):
        text = next(t for d, t, _ in rows if d == r.doc_id)
        hits, whole = dict.fromkeys(names, 0.0), 0.0
        for g in plain_grams(text):
            inside = [k for k in names if g in has[k]]
            w = np.log((len(names) + 1) / max(len(inside), 1))
            whole += w
            for k in inside:
                hits[k] += w
        best = max(names, key=lambda k: hits[k])
        assert r.lang_pred == (best if whole else "und")
        assert abs(r.score - (hits[best] / whole if whole else 0)) < 0.01


def test_filters_hold_rare_ngrams(spark):
    """An n-gram seen three times is in its language's filter, however large the language is."""
    rows = [("the quick brown fox jumps over the lazy dog " * 300, "en")] + [("zyx qvw", "en")] * 3 + [("der hund und die katze " * 50, "de")]
    filters = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert filters.predict(["zyx qvw"])[0] == ["en"] and filters.predict(["zyx qvw"])[1][0] > 0.99


@pytest.mark.parametrize("ids", ["missing", "repeated"])
def test_copies_without_ids_of_their_own_are_spread(spark, ids):
    rows = [(i, f"own text {i} " * 8) for i in range(4000)] + [(None if ids == "missing" else 5, "copied text of some length " * 40)] * 4000
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 40)
    size = {r["shard"]: r["sum(size)"] for r in got.groupBy("shard").sum("size").collect()}
    assert max(size.values()) <= max(1.02 * sum(size.values()) / 40, sum(size.values()) / 40 + 1200)


def test_groups_below_the_limit_stay_whole(spark):
    """Copies that make up less than half a shard share it, however many times the mean group they are."""
    rows = [(i, f"own text {i} " * 20) for i in range(8000)] + [(9000 + i, "copied text " * 20) for i in range(90)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 40).filter("doc_id >= 9000")
    assert got.select("shard").distinct().count() == 1
