"""SimHash near-duplicate detection with BK-trees.

A fingerprint has 64 bits: a bit is 1 where it is set in over half of the
shingles' XXH64 values.  Fingerprints within ``radius`` bits are linked, and
linked documents form components.

Search.  Two fingerprints within ``radius`` bits agree on at least ``a`` of
``radius + a`` segments, so each choice of ``a`` segments is a shard key and the
rows of a shard hold every neighbour that agrees there; no pair is lost.  ``a``
follows the number of distinct fingerprints, so that shards stay small at any
size.  In a shard the fingerprints form a BK-tree (children keyed by their
integer Hamming distance to the parent); a query at distance d from a node
follows only the edges d - radius .. d + radius.  A shard of more than
``SHARD_ROWS`` fingerprints is cut into several trees, and each tree is sent to
all query chunks of its shard.  Only links that join two sets of a shard leave
it, so a dense shard emits at most one link per fingerprint and never its pairs.

Components come from large-star / small-star rounds over the links, each round
written to the shared folder; nothing is collected.

Defined results: a null or blank text has fingerprint zero, which is linked like
any other; repeated rows share fingerprint and component; a null doc_id stays a
row and never names a component (component null if no id is reachable); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches

BITS = 64
#: Fingerprints of one shard tree; larger shards are cut into several trees.
SHARD_ROWS = 4096
#: Expected fingerprints of a shard above which one more segment has to agree.
SHARD_TARGET = 128
#: Parts that the links of one node are dealt to.
SALTS = 16
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of the ``shingle``-word windows of an UTF-8 text."""
    words = (text or b"").lower().split()  # ASCII letters; ASCII white space
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(joined, seed), "big")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, ones = len(words) - shingle + 1, np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        raw = b"".join([digest(joined[s:e], seed) for s, e in
                        zip(starts[at:to].tolist(), ends[at + shingle - 1:to + shingle - 1].tolist())])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, seed: int = 42) -> DataFrame:
    """(doc_id, th, fp) of each row: th is a hash of the text, fp the fingerprint as signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             ["doc_id", "th", "fp"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                              F.col("text").cast("binary").alias("text")], "doc_id long, th long, fp long", run)


def agreeing(n: int, radius: int) -> int:
    """Segments that have to agree so that a shard holds about SHARD_TARGET of n fingerprints."""
    for a in range(1, radius + 1):
        if n <= SHARD_TARGET << (BITS // (radius + a) * a):
            return a
    return max(1, radius)


def shard_keys(radius: int, a: int) -> list:
    """One key expression per choice of ``a`` segments; the choice's number keeps keys apart."""
    m = radius + a
    edges = [BITS * i // m for i in range(m + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(m), a)):
        parts = [F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
                 if m > 1 else F.col("fp") for i in chosen]
        keys.append(F.struct(F.lit(k).alias("k"), F.xxhash64(*parts).alias("v")))
    return keys


class ShardTree:
    """A BK-tree that also keeps the sets its links have joined.

    A subtree known to lie wholly in the query's own set is not entered: nothing in
    it could join two sets.
    """

    def __init__(self, radius: int):
        self.radius, self.fp, self.kids, self.up, self.whole = radius, [], [], [], []
        self.looked = 0

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def node(self, fp: int) -> int:
        self.fp.append(fp)
        self.kids.append({})
        self.up.append(len(self.up))
        self.whole.append(False)
        return len(self.fp) - 1

    def insert(self, i: int) -> None:
        """Hang node i below the root; the first inserted node is the root."""
        if i == self.root:
            return
        at, fps, fp, whole, mine = self.root, self.fp, self.fp[i], self.whole, self.find(i)
        while True:
            if whole[at] and self.find(at) != mine:
                whole[at] = False
            d = (fps[at] ^ fp).bit_count()
            down = self.kids[at].get(d)
            if down is None:
                self.kids[at][d] = i
                return
            at = down

    root = 0

    def search(self, i: int) -> list[tuple[int, int]]:
        """Links from node i to tree nodes within the radius that join two sets."""
        r, fps, kids, fp, whole = self.radius, self.fp, self.kids, self.fp[i], self.whole
        found, stack = [], [self.root]
        while stack:
            at = stack.pop()
            if whole[at] and self.find(at) == self.find(i):
                continue
            d = (fps[at] ^ fp).bit_count()
            if d <= r:
                a, b = self.find(i), self.find(at)
                if a != b:
                    self.up[max(a, b)] = min(a, b)
                    found.append((fp, fps[at]))
            for edge, down in kids[at].items():
                if d - r <= edge <= d + r:
                    stack.append(down)
        self.looked += 1
        if self.looked & (self.looked - 1) == 0:
            self.settle()
        return found

    def settle(self) -> None:
        """Mark again which subtrees lie in one set; run after 1, 2, 4, 8 ... searches."""
        order, stack = [], [self.root]
        while stack:
            at = stack.pop()
            order.append(at)
            stack += self.kids[at].values()
        for at in reversed(order):  # children come before their parents
            self.whole[at] = all(self.whole[k] and self.find(k) == self.find(at) for k in self.kids[at].values())


def shard_links(tree_fps: list[int], query_fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Set-joining links inside ``tree_fps`` (no queries), or from queries to the tree."""
    tree, out = ShardTree(radius), []
    if not query_fps:
        for fp in tree_fps:
            i = tree.node(fp)
            if i:
                out += tree.search(i)
            tree.insert(i)
        return out
    for fp in tree_fps:
        tree.insert(tree.node(fp))
    for fp in query_fps:
        out += tree.search(tree.node(fp))
    return out


def _groups(batches):
    """Runs of equal (k, v, i, j) of sorted batches: (is_query array, fp array) of runs of two or more rows."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(6)])
        cols = cols if rest is None else np.concatenate((rest, cols), axis=1)
        edges = np.flatnonzero((cols[:4, 1:] != cols[:4, :-1]).any(axis=0)) + 1
        at = [0, *edges.tolist()]
        for s, e in zip(at, at[1:], strict=False):
            if e - s > 1:
                yield cols[4, s:e], cols[5, s:e]
        rest = cols[:, at[-1]:]
    if rest is not None and rest.shape[1] > 1:
        yield rest[4], rest[5]


def links(distinct_fps: DataFrame, radius: int, n: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits; ``n`` rows come in."""
    keyed = (distinct_fps.select("fp", F.explode(F.array(*shard_keys(radius, agreeing(n, radius)))).alias("s"))
             .select("fp", "s.k", "s.v"))
    trees = (keyed.groupBy("k", "v").count().filter(F.col("count") > shard_rows)
             .select("k", "v", F.ceil(F.col("count") / shard_rows).cast("int").alias("c")))
    # chunk of a row in a large shard, and every pair of chunks it takes part in
    dealt = (keyed.join(trees, ["k", "v"], "left")
             .withColumn("c", F.coalesce("c", F.lit(1)))
             .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("c")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
             .select("k", "v", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"),
                     (F.col("own") > F.col("o")).cast("int").alias("q"), "fp"))

    def run(batches):
        a, b = [], []
        for q, fp in _groups(batches):
            u = fp.view(np.uint64)
            for x, y in shard_links(u[q == 0].tolist(), u[q == 1].tolist(), radius):
                a.append(x)
                b.append(y)
            if len(a) > 50_000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    return (dealt.repartition("k", "v", "i", "j").sortWithinPartitions("k", "v", "i", "j", "q", "fp")
            .mapInArrow(run, "a long, b long"))


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])


def _contract(batches):
    """The links of one task as stars: (u, its set's smallest member)."""
    up: dict[int, int] = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    pairs = [(x, find(x)) for x in list(up)]
    pairs = [p for p in pairs if p[0] != p[1]]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])


def _salted(links: DataFrame, per_node: DataFrame) -> DataFrame:
    """Join on ``u`` with one row per node; a node's links are spread over ``SALTS`` keys, as a hub may hold most."""
    spread = links.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    each = per_node.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # no broadcast: its size would be judged before the salts multiply it
    return spread.join(each.hint("merge"), ["u", "s"]).drop("s")


def components(link_rows: DataFrame) -> DataFrame:
    """(u, v): each linked node u but the smallest of its component, with that smallest node v."""
    stars = cut(link_rows.mapInArrow(_contract, "u long, v long"), "stars")
    state = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return stars
        state = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted(both.filter("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (_salted(large, low).select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        stars = cut(small, "stars")


def simhash_components(docs: DataFrame, shingle: int, radius: int, seed: int = 42) -> DataFrame:
    """(doc_id, th, fp, root, component_id) of each row of ``docs`` (doc_id, text, ...).

    ``root``: the component's smallest fingerprint; ``component_id``: its smallest doc_id.
    """
    fps = cut(fingerprints(docs, shingle, seed), "fingerprints")
    each = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = components(links(each.select("fp"), radius, each.count()))
    named = (each.join(roots, each.fp == roots.u, "left")
             .select("fp", "rep", F.coalesce("v", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = named.join(least, "root").select("fp", "root", "component_id")
    return fps.join(of, "fp").select("doc_id", "th", "fp", "root", "component_id")


def hex_fingerprint(fp):
    """16 lower-case hex digits of a signed 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int, radius: int, seed: int = 42) -> DataFrame:
    """One row of each component: its smallest doc_id, then the smallest text hash.

    A component without any id keeps one row too.
    """
    chosen = (simhash_components(docs, shingle, radius, seed)
              .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
              .groupBy("root", F.col("component_id").alias("__id")).agg(F.min("th").alias("__th"))
              .select("__id", "__th"))
    chosen = cut(chosen, "chosen")
    marked = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("doc_id").cast("long").alias("__did"),
                         F.xxhash64("text").alias("__dth"))
    kept = marked.join(chosen, F.col("__did").eqNullSafe(F.col("__id")) & (F.col("__dth") == F.col("__th")), "left_semi")
    return kept.dropDuplicates(["__did", "__dth"]).drop("__did", "__dth")
