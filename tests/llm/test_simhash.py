import random

import pytest
import xxhash
from conftest_paths import SMALL

from sensorweave.llm import simhash as S


def plain_fingerprint(text, k=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, radius=4):
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    up = {f: f for f in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius and find(a) != find(b):
                up[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for (doc, _), f in zip(rows, fps, strict=True):
        r = find(f)
        least[r] = min([x for x in (least.get(r), doc) if x is not None], default=None)
    return sorted(((doc, f"{f:016x}", least[find(f)]) for (doc, _), f in zip(rows, fps, strict=True)), key=str)


@pytest.mark.parametrize("where", ["edge", SMALL])
def test_brute_force(where, edge_dir, results, tables):
    d = edge_dir if where == "edge" else where
    rows = tables(d).execute("SELECT doc_id, text FROM documents").fetchall()
    rows = [r for r in rows if r[1] is None or len(r[1]) < 100_000]
    texts = dict(rows)
    got = [tuple(r) for r in results("op1_simhash", d) if r[0] in texts]
    assert sorted(got, key=str) == plain_components(rows)


def test_empty(empty_dir, results):
    assert results("op1_simhash", empty_dir) == []


@pytest.mark.parametrize("rows", [3, 4096])
def test_dense_groups_lose_no_link(spark, rows):
    """A dense ball of fingerprints, a chain and strangers; shards of 3 rows are cut into many trees."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    at = rng.getrandbits(64)
    for b in range(0, 60, 3):
        fps.add(at)
        at ^= 7 << b
    fps |= {rng.getrandbits(64) for _ in range(40)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = S.links(spark.createDataFrame(signed, "fp long"), 4, len(fps), shard_rows=rows)
    got = {r.u % (1 << 64): r.v % (1 << 64) for r in S.components(links).collect()}
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                up[find(a)] = find(b)
    for a in fps:
        for b in fps:
            assert (find(a) == find(b)) == (got.get(a, a) == got.get(b, b))


def test_every_number_of_agreeing_segments(spark):
    base = 0x0123456789ABCDEF
    rng = random.Random(2)
    pairs = [(base, base ^ sum(1 << b for b in rng.sample(range(64), 4))) for _ in range(20)]
    for n in (10, 10**6, 10**9, 10**12):
        a = S.agreeing(n, 4)
        keys = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for ab in pairs for p in ab], "fp long") \
            .select("fp", *[k.alias(f"k{i}") for i, k in enumerate(S.shard_keys(4, a))]).collect()
        for x, y in zip(keys[::2], keys[1::2], strict=True):
            assert any(u == v for u, v in zip(x[1:], y[1:], strict=True))
    assert [S.agreeing(n, 4) for n in (10, 10**7, 10**9, 10**12)] == [1, 2, 3, 4]


def test_keep_one(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = S.keep_one(docs, 4, 4)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    want = {r.component_id for r in S.simhash_components(docs, 4, 4).collect()}
    assert sorted(ids, key=str) == sorted(want, key=str)
