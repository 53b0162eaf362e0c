"""A generalised additive model with pairwise interactions, scoring text quality.

Features of the whole text are binned at the quantiles of the learning rows.  Shallow
trees (a few leaves over the bins of one feature, or over the bin grid of one pair) are
boosted in cycles over the features, then over the pairs with the strongest remaining
interaction; every tree only adds to its feature's lookup table.  What is left of the
model is one table for each feature and pair, and a text's log-odds are the sum of its
bins' entries.

The features of all texts are computed once, on the executors.  Learning takes at most
``SAMPLE_ROWS`` labelled rows, chosen by a hash of the id, so that fitting is bounded.

Defined results: null and empty texts have all features zero and are scored; rows without
a label teach nothing; several labels of one document count as their mean; repeated rows are scored alike and null ids
are scored but never learned from; without any labelled row every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches

#: Bound on the labelled rows that the model is fitted on.
SAMPLE_ROWS = 100_000
BINS = 32
PAIR_BINS = 8

FEATURES = ("words", "word_length", "length_spread", "distinct", "commonest", "lines", "line_words", "same_lines",
            "short_lines", "capitals", "digits", "marks", "symbols", "other", "sentence_ends", "repeats")

_KINDS = np.full(256, 4, np.uint8)  # 0 blank, 1 capital, 2 digit, 3 mark, 4 other byte of a letter, 5 symbol
_KINDS[:33] = 0
_KINDS[33:127] = 3
_KINDS[48:58] = 2
_KINDS[65:91] = 1
_KINDS[97:123] = 6
for _c in b"#*$%&|<>{}[]=_~^\\@":
    _KINDS[_c] = 5


def features(text: bytes | None) -> list[float]:
    """The FEATURES of a whole text (UTF-8)."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=7)
    length = np.fromiter(map(len, words), np.int64, n)
    chars = int(length.sum())
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    pairs = set(zip(words, words[1:], strict=False))
    ends = text.count(b".") + text.count(b"!") + text.count(b"?")
    return [float(np.log1p(n)), chars / n, float(length.std()), len(counts) / n, max(counts.values()) / n,
            float(np.log1p(len(lines))), n / len(lines), 1 - len(set(lines)) / len(lines),
            sum(len(line) < 20 for line in lines) / len(lines), kinds[1] / chars, kinds[2] / chars, kinds[3] / n, kinds[5] / n,
            kinds[4] / chars, ends / n, 1 - len(pairs) / max(1, n - 1)]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, f array<float>) of each row."""
    def run(batches):
        for b in batches:
            rows = [np.array(features(t), np.float32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "f"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")],
                       "doc_id long, f array<float>", run)


@dataclass
class Additive:
    """Bin edges and lookup tables; ``pairs`` lists the feature pairs of ``grids``."""
    edges: list[np.ndarray]
    base: float
    tables: np.ndarray
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: np.ndarray

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of features."""
        out = np.full(len(x), self.base)
        fine, coarse = self.bins(x, self.edges), self.bins(x, self.coarse)
        for k, table in enumerate(self.tables):
            out += table[fine[:, k]]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-out))


def _split_bins(grad: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Leaf value of each bin of a shallow tree that splits the bin axis greedily."""
    g, h = np.concatenate(([0], np.cumsum(grad))), np.concatenate(([0], np.cumsum(weight)))

    def gain(s, e, c):
        def part(a, b):
            return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
        return part(s, c) + part(c, e) - part(s, e)

    cuts = [0, len(grad)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for s, e in zip(cuts, cuts[1:], strict=False):
            c = np.arange(s + 1, e)
            c = c[(h[c] - h[s] >= least) & (h[e] - h[c] >= least)]
            if len(c):
                v = gain(s, e, c)
                i = int(v.argmax())
                best = max(best, (float(v[i]), int(c[i])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for s, e in zip(cuts, cuts[1:], strict=False):
        out[s:e] = (g[e] - g[s]) / (h[e] - h[s] + 1.0)
    return out


def _split_grid(grad: np.ndarray, weight: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Leaf values of the best two-level tree over a pair's grid, and its gain: one cut of a row axis, then one of each side."""
    best = (0.0, np.zeros_like(grad))
    for turned in (False, True):
        g, h = (grad.T, weight.T) if turned else (grad, weight)
        for c in range(1, len(g)):
            out, total = np.zeros_like(g), 0.0
            for rows in (slice(0, c), slice(c, len(g))):
                side_g, side_h = g[rows].sum(axis=0), h[rows].sum(axis=0)
                values = _split_bins(side_g, side_h, 2, least)
                out[rows] = values
                total += float((values * side_g).sum())
            if total > best[0]:
                best = (total, out.T if turned else out)
    return best[1], best[0]


def train(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.1, n_pairs: int = 6, pair_rounds: int = 25) -> Additive:
    """Cyclic boosting of the log-odds of ``y`` (0 to 1)."""
    n, k = x.shape
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], shares)) for j in range(k)] if n else [np.zeros(0)] * k
    coarse = [e[np.linspace(0, len(e) - 1, PAIR_BINS - 1).astype(int)] if len(e) >= PAIR_BINS else e for e in edges]
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    model = Additive(edges, float(np.log(mean / (1 - mean))), np.zeros((k, BINS)), coarse, [], np.zeros((0, PAIR_BINS, PAIR_BINS)))
    if not n:
        return model
    fine, rough = model.bins(x, edges), model.bins(x, coarse)
    odds, least = np.full(n, model.base), max(2.0, 0.0005 * n)

    def slope():
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(k):
            g, h = slope()
            step = rate * _split_bins(np.bincount(fine[:, j], g, BINS), np.bincount(fine[:, j], h, BINS), 4, least / 4)
            model.tables[j] += step
            odds += step[fine[:, j]]
    cell = {(a, b): rough[:, a] * PAIR_BINS + rough[:, b] for a in range(k) for b in range(a + 1, k)}

    def grid(ab):
        g, h = slope()
        size = PAIR_BINS * PAIR_BINS
        return _split_grid(*(np.bincount(cell[ab], v, size).reshape(PAIR_BINS, PAIR_BINS) for v in (g, h)), least / 4)

    strength = {ab: grid(ab)[1] for ab in cell}
    model.pairs = sorted(cell, key=lambda ab: (-strength[ab], ab))[:n_pairs]
    model.grids = np.zeros((len(model.pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(pair_rounds):
        for i, ab in enumerate(model.pairs):
            step = rate * grid(ab)[0]
            model.grids[i] += step
            odds += step.ravel()[cell[ab]]
    return model


def fit(found: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Additive:
    """The model of ``labels`` (doc_id, label) on the stored features ``found``."""
    known = (labels.filter("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast("long").alias("l_id"))
             .agg(F.avg("label").alias("label")))
    # one row of each labelled document; the bound falls evenly by hash of the id
    share = min(1.0, sample / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("l_id", F.lit(3)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    rows = (found.join(chosen, F.col("doc_id") == F.col("l_id")).groupBy("doc_id")
            .agg(F.min("f").alias("f"), F.first("label").alias("label")))
    data = rows.orderBy("doc_id").select("f", "label").toPandas()
    x = np.array(data["f"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return train(x, data["label"].to_numpy(float))


def score(found: DataFrame, model: Additive) -> DataFrame:
    """(doc_id, score) of the stored features."""
    parts = (model.edges, model.base, model.tables, model.coarse, model.pairs, model.grids)

    def run(batches):
        own = Additive(*parts)
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.score(x))], ["doc_id", "score"])

    return found.mapInArrow(run, "doc_id long, score double")
