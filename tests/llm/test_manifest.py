import hashlib
import random
import zlib

import pytest

from sensorweave.llm import manifest as M


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(level, place):
    """Siblings of a place and the top of the tree over ``level``."""
    sib = []
    while len(level) > 1:
        run = place - place % 3
        sib.append((level[run:place], level[place + 1:run + 3]))
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        place //= 3
    return sib, level[0]


def plain(rows):
    groups = {}
    for doc, source, lang, n, text in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None
        given = leaf(doc, source, lang, n, text.replace("\n", "") if hit else text)
        groups.setdefault(source, []).append((doc is not None, doc or 0, leaf(doc, source, lang, n, text), given, doc))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: x[:4])
    tops = [climb([x[2] for x in groups[s]], 0)[1] for s in order]
    out = []
    for k, s in enumerate(order):
        leaves = [x[2] for x in groups[s]]
        outer, root = climb(tops, k)
        for i, (_, _, own, given, doc) in enumerate(groups[s]):
            sib, top = climb(leaves, i)
            folded = given
            for before, after in sib + outer:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join(h for b, a in sib + outer for h in b + a))
            out.append((doc, own, top, root, proof, folded, folded == root))
    return sorted(out, key=str)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [3], [4], [82], [1, 1, 2], [243, 1, 244, 2], [1] * 245 + [100, 730]])
def test_brute_force(spark, sizes):
    """Trees of one leaf, of whole and of broken runs, and more groups than one stored row holds."""
    rng = random.Random(len(sizes))
    rows = [(rng.randint(-9, 10**6), f"s{g}" if g else None, rng.choice(["en", None, "é"]), rng.choice([None, 5]), rng.choice(["a\nb", "", None, "ü"]))
            for g, n in enumerate(sizes) for _ in range(n)]
    rows += [rows[0], (None, *rows[0][1:])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", pos int, leaf string").repartition(3)
    assert sorted([tuple(r) for r in M.verify(df).collect()], key=str) == plain(rows)


def test_only_tampered_rows_fail(spark):
    rows = [(i, "s", "en", 3, "a\nb" if i % 3 else "ab") for i in range(200)]
    got = {r["doc_id"]: r["verified"] for r in M.verify(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert {i for i, ok in got.items() if not ok} == {i for i in range(200) if i % 3 and zlib.crc32(str(i).encode()) % 2 == 0}


def test_edges(edge_dir, results, tables):
    rows = tables(edge_dir).execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()
    assert sorted([tuple(r) for r in results("op13_manifest", edge_dir)], key=str) == plain(rows)
