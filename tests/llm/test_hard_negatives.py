import random

import numpy as np
import pytest

from sensorweave.llm import hard_negatives as H


def plain(rows, positives=5, negatives=10, low=30, high=90, every=100):
    """Rows (id, label, vector) by all products in Python's integers."""
    rows = [(i, lab, [H.whole(float(x)) for x in v]) for i, lab, v in rows
            if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (aid, alab, av) in enumerate(rows):
        if aid is None or aid % every:
            continue
        scored = sorted(((sum(x * y for x, y in zip(av, v)), i is None, i, lab) for b, (i, lab, v) in enumerate(rows) if b != a),
                        key=lambda x: (-x[0], x[1], x[2] or 0))
        for ps, _, pid, _ in [s for s in scored if s[3] == alab][:positives]:
            inside = [s for s in scored if s[3] != alab and low * ps <= 100 * s[0] <= high * ps][:negatives]
            out += [(aid, pid, n, s[2], clip(ps), clip(s[0])) for n, s in enumerate(inside, 1)]
    return sorted(out, key=str)


def clip(x):
    return max(min(x, H.MOST), H.LEAST)


@pytest.mark.parametrize("size", [1, 8, 200, 4000])
@pytest.mark.parametrize("width", [0, 1, 7, 64, 300])
def test_packed_scores_are_products(size, width):
    rng = np.random.default_rng(size + width)
    rows, anchors = rng.integers(-size, size + 1, (23, width)), rng.integers(-size, size + 1, (5, width))
    packed = H.Packed(rows, max(1, int(anchors.max(initial=0)) - int(anchors.min(initial=0))))
    wide = H.WidePacked(rows.tolist())
    for a in anchors:
        assert packed.scores(a).tolist() == (rows @ a).tolist() == wide.scores(a.tolist())


def test_wide_scores_beyond_64_bits():
    rows = [[1 << 80, -(1 << 70), 3], [0, 0, 0], [-5, 1 << 90, 1]]
    anchor = [-(1 << 60), 7, 1 << 30]
    assert H.WidePacked(rows).scores(anchor) == [sum(x * y for x, y in zip(r, anchor, strict=True)) for r in rows]


def test_order_text_sorts_as_the_numbers_do():
    rng = random.Random(1)
    numbers = [0, 1, -1, 9, 10, -9, -10, *[rng.randint(-10**k, 10**k) for k in range(1, 60) for _ in range(5)]]
    assert sorted(numbers) == sorted(numbers, key=H.order_text)


@pytest.mark.parametrize("kind", ["plain", "ties", "wild"])
def test_brute_force(spark, monkeypatch, kind):
    """Small parts and slices, repeated ids, a label of half the rows, vectors of other lengths and sizes."""
    monkeypatch.setattr(H, "PART_ROWS", 37)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 5)
    rng = random.Random(kind)

    def component():
        if kind == "ties":
            return float(rng.choice([0, 0, 1, -1]))
        return rng.gauss(0, 0.3) * (rng.choice([1, 1, 1, 1e5, 1e30, 1e200]) if kind == "wild" and rng.random() < 0.1 else 1)

    rows = [(rng.choice([i, i, i // 2]), rng.choice([0, 0, 0, 1, 2, 3]), [component() for _ in range(12)]) for i in range(300)]
    rows += [(None, 0, rows[0][2]), (None, 1, rows[1][2]), rows[0], (600, 0, []), (700, 1, [0.7] * 3), (900, None, rows[0][2]),
             (1000, 1, None), (1100, 1, [None] + rows[1][2][1:]), (1200, 1, [float("nan")] * 12), (-100, 2, rows[5][2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id long, label int, vector array<double>, row string").repartition(3)
    got = [tuple(r) for r in H.mine(H.prepared(df), every=20).collect()]
    assert sorted(got, key=str) == plain(rows, every=20)
    assert len(got) > 50
