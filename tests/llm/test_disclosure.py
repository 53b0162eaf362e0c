"""Disclosing terms recomputed in plain Python: counts of distinct texts, the share, and every place that goes."""

import math
import random
import re

import pytest

from sensorweave.llm import common, sanitise

EDGE = re.escape(sanitise._EDGE)


def bare(word):
    return re.sub(f"^[{EDGE}]+|[{EDGE}]+$", "", word)


def plain_terms(texts, support, generalise, remove):
    """Per text: sorted (start, end, removed)."""
    distinct = sorted(set(texts))
    n, n_e, n_t, n_et, held = len(distinct), {}, {}, {}, {}
    for t in distinct:
        spans = sanitise.base_spans(t)
        words = [(m.start(), m.end(), m.group()) for m in re.finditer(r"\S+", t)]
        free = [None if any(s < e2 and s2 < e for _, s2, e2 in spans) else bare(w).lower() or None for s, e, w in words]
        # n_t counts the words of the whole text, cut at blanks, spans or not
        for w in {bare(w).lower() for w in t.split()} - {""}:
            n_t[w] = n_t.get(w, 0) + 1
        found = set()
        for kind, s, e in spans:
            who = sanitise.entity(kind, t[s:e])
            first = sum(e2 <= s for _, e2, _ in words)
            last = sum(s2 < e for s2, _, _ in words)
            near = free[max(first - sanitise.CONTEXT_WORDS, 0):last + sanitise.CONTEXT_WORDS]
            found |= {(who, w) for w in near if w}
        held[t] = {sanitise.entity(k, t[s:e]) for k, s, e in spans}
        for who in held[t]:
            n_e[who] = n_e.get(who, 0) + 1
        for pair in found:
            n_et[pair] = n_et.get(pair, 0) + 1
    strong = {}
    for (who, w), both in n_et.items():
        if both >= support and n_e[who] < n:
            share = 1 - math.log(max(n_t.get(w, 0), both) / both) / math.log(max(n, 2) / n_e[who])
            if share >= generalise:
                strong[who, w] = share >= remove
    out = []
    for t in texts:
        spans, marks = sanitise.base_spans(t), {}
        for m in re.finditer(r"\S+", t):
            if any(m.start() < e and s < m.end() for _, s, e in spans):
                continue
            w = bare(m.group())
            lead = m.start() + m.group().find(w)
            hit = [strong[who, w.lower()] for who in held[t] if (who, w.lower()) in strong]
            if w and hit:
                marks[lead, lead + len(w)] = any(hit)
        out.append(sorted((s, e, r) for (s, e), r in marks.items()))
    return out


@pytest.mark.parametrize(("seed", "support"), [(1, 2), (2, 1), (3, 3)])
def test_terms_by_brute_force(spark, tmp_path, seed, support):
    rng = random.Random(seed)
    common_words = [f"word{i}" for i in range(60)]
    people = [(f"name{i}", f"n{i}@corp.example.com") for i in range(8)]
    texts = []
    for i in range(260):
        words = [rng.choice(common_words) for _ in range(rng.randint(3, 60))]
        if rng.random() < 0.3:
            name, mail = rng.choice(people)
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice([mail, f"({mail}),"])]
            for _ in range(rng.randint(0, 2)):
                words.insert(rng.randrange(len(words)), rng.choice([name, name.upper() + "!", f"'{name}'"]))
        elif rng.random() < 0.03:
            words.append(rng.choice(people)[0])
        texts.append(rng.choice([" ", "\n"]).join(words))
    texts += [texts[3], texts[5], texts[5], "", texts[7]]
    d = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(d)
    rows = sanitise.find(spark.read.parquet(d), support).collect()
    got = {r["doc_id"]: [(t["start"], t["end"], t["removed"]) for t in r["terms"]] for r in rows}
    want = plain_terms(texts, support, 0.85, 0.95)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(map(len, want)) > 20


def test_bitmap_grows_with_its_members(spark):
    small, large = (spark.range(n).selectExpr("xxhash64(id) as h") for n in (10, 100_000))
    (a, _), (b, words) = common.bitmap(small, "h"), common.bitmap(large, "h")
    assert a == 22 and b == 23 and len(words) == 1 << 17
    assert all(sanitise._holds((b, words), r["h"]) for r in large.limit(1000).collect())
    assert common.bitmap(large, "h", 18)[0] == 18
