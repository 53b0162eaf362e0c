"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (hamming_search, hard_negatives, langid, license_scan, manifest, mixing, packing, quality_model, quality_rules, sanitise,
               sharding, simhash, substring_dedup)
from .common import cut, documents

QUERIES = {}
ORACLES = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components: 4-word shingles, 4 bits."""
    return simhash.simhash_components(documents(spark, sf_dir), 4, 4).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-two-fit packing into sequences of at most 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path(), 2048)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted fair queueing over all sources."""
    rows = documents(spark, sf_dir).select(F.col("doc_id"), F.col("source"), mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix(rows).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op7_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + rk % 3] AS w FROM s),
c AS (
  SELECT *, coalesce(sum(3 * source_size) OVER o, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS open,
         sum(source_size) OVER () AS budget
  FROM w WINDOW o AS (ORDER BY 3.0 * source_size / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT CAST(budget - capped AS DOUBLE) / CAST(open AS DOUBLE) AS level FROM c
       WHERE 3 * source_size >= w * (CAST(budget - capped AS DOUBLE) / CAST(open AS DOUBLE))
       ORDER BY 3.0 * source_size / w, rk LIMIT 1),
t AS (SELECT source, source_size, rk, w, budget,
             least(CAST(3 * source_size AS DOUBLE), coalesce(w * (SELECT level FROM lv), 1e300)) AS target FROM c),
p AS (SELECT d.*, t.source_size, t.rk, t.w, t.target, t.budget,
             sum(size) OVER (PARTITION BY t.rk ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER (ORDER BY t.rk, h, doc_id, size) AS no
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT no, size, budget, sum(size) OVER (ORDER BY (turn * source_size + upto) * (10 // w), rk, h, doc_id, no, turn
                                              ROWS UNBOUNDED PRECEDING) AS placed
      FROM p, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0),
g AS (SELECT no, CAST(sum(size) AS BIGINT) AS taken FROM k WHERE placed <= budget GROUP BY no)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM p LEFT JOIN g USING (no)
"""


def language_filters(docs: DataFrame) -> langid.Filters:
    """Learned from text and language of the documents that are not held out."""
    return langid.fit(docs.filter(langid.may_learn(F.col("doc_id"))).select("text", "lang"))


@query
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by bit-sliced n-gram filters."""
    docs = documents(spark, sf_dir)
    found = langid.identify(docs.select("doc_id", "text"), language_filters(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it, in every whole text."""
    return sanitise.digest(sanitise.find(documents(spark, sf_dir)))


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template places of every whole text."""
    return license_scan.digest(license_scan.scan(documents(spark, sf_dir)))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, and adaptive thresholds for each language and source."""
    return quality_rules.apply(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _rules_oracle(reach: float = 3.0, least_docs: int = 50) -> str:
    """DuckDB SQL of op5, generated from the same feature list."""
    spec = quality_rules.FEATURES
    expr = {f: e.replace(" div ", " // ") for f, (e, _, _) in spec.items()}
    values = ", ".join(f"('{f}', {e})" for f, e in expr.items())
    base = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
    bucket = "((v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0))"
    low = "CASE feature " + " ".join(
        f"WHEN '{f}' THEN " + (f"q1 - {reach} * greatest(q3 - q1, {least})" if both else "-1.0")
        for f, (_, both, least) in spec.items()) + " END"
    high = "CASE feature " + " ".join(f"WHEN '{f}' THEN q3 + {reach} * greatest(q3 - q1, {least})"
                                      for f, (_, _, least) in spec.items()) + " END"

    def fences(name: str, source: str, keys: str) -> str:
        by = (keys + ", " if keys else "") + "feature"
        return f"""
{name} AS (SELECT {by}, total, {low} AS lo, {high} AS hi FROM (
  SELECT {by}, max(total) AS total, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM (SELECT {by}, b, sum(n) OVER (PARTITION BY {by} ORDER BY b) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
        FROM (SELECT {by}, b, sum(n) AS n FROM {source} GROUP BY {by}, b)) GROUP BY {by}))"""

    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times FROM (
        SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w))),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM g WHERE times > 1) GROUP BY rid),
f AS (SELECT rid, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(regexp_extract_all(t, '[^\p{{L}}\p{{N}}\x20\x09-\x0D]')) AS BIGINT) AS n_marks,
        CAST(len(regexp_extract_all(t, '\p{{Lu}}')) AS BIGINT) AS n_capitals,
        CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN r USING (rid)),
v AS (SELECT rid, lang, source, feature, CAST(v AS BIGINT) AS v
      FROM f, LATERAL (VALUES {values}) AS x(feature, v) WHERE NOT {base}),
s AS (SELECT lang, source, feature, {bucket} AS b, count(*) AS n FROM v GROUP BY ALL),{fences('own', 's', 'lang, source')},
{fences('byl', 's', 'lang')},{fences('alls', 's', '')},
bad AS (SELECT DISTINCT rid FROM v
  LEFT JOIN own ON v.lang IS NOT DISTINCT FROM own.lang AND v.source IS NOT DISTINCT FROM own.source
    AND v.feature = own.feature AND own.total >= {least_docs}
  LEFT JOIN byl ON v.lang IS NOT DISTINCT FROM byl.lang AND v.feature = byl.feature AND byl.total >= {least_docs}
  JOIN alls ON v.feature = alls.feature
  WHERE v.v < coalesce(own.lo, byl.lo, alls.lo) OR v.v > coalesce(own.hi, byl.hi, alls.hi))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed,
       NOT {base} AND bad.rid IS NULL AS kept
FROM f LEFT JOIN bad USING (rid)
"""


ORACLES["op5_quality_rules"] = _rules_oracle()


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    return sharding.shard(documents(spark, sf_dir), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


@query
def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text by an additive model of the labelled rows that are not held out."""
    found = cut(quality_model.measured(documents(spark, sf_dir)), "features")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(langid.may_learn(F.col("doc_id")))
    model = quality_model.fit(found, labels.select("doc_id", F.col("quality").alias("label")))
    return quality_model.score(found, model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def sign_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, code) of each vector: its sign bits; a repeated id counts once."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("vec_id is not null and size(embedding) > 0")
    return vectors.select(F.col("vec_id").cast("long").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code")) \
        .groupBy("id").agg(F.min("code").alias("code"))


@query
def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes, by Hamming distance, of every vector whose id is divisible by 100."""
    codes = cut(sign_codes(spark, sf_dir), "codes")
    return hamming_search.top_k(codes, codes.filter("id % 100 = 0"), 10).select(
        F.col("qid").alias("query_id"), F.col("id").alias("vec_id"), "distance", F.col("rank").cast("long").alias("rank"))


ORACLES["op2_hamming_topk"] = """
WITH v AS (SELECT vec_id AS id, arg_min(code, list_sum(list_transform(range(1, 65), lambda i:
                    code[i] * CASE WHEN i = 64 THEN -(CAST(1 AS HUGEINT) << 63) ELSE CAST(1 AS HUGEINT) << (i - 1) END))) AS code FROM (
  SELECT vec_id, list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 AND NOT isnan(embedding[i]) THEN 1 ELSE 0 END) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0) GROUP BY vec_id),
d AS (SELECT q.id AS query_id, v.id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.code, v.code), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
      FROM v AS q JOIN v ON q.id % 100 = 0 AND q.id <> v.id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 10
"""


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents and the proof of each, climbed by a recursive query."""
    return manifest.verify(documents(spark, sf_dir))


ORACLES["op13_manifest"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text,
         coalesce(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS UBIGINT))),
           lambda a, x: list_reduce(list_prepend(xor(a, x), CAST(range(8) AS UBIGINT[])),
             lambda b, i: xor(b >> 1, CAST(3988292384 AS UBIGINT) * (b & 1)))), CAST(4294967295 AS UBIGINT)) % 2 = 0, false) AS hit
  FROM documents),
l AS (
  SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(t2) || ':' || t2, '-')) AS given
  FROM (SELECT *, CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END AS t2 FROM d)),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, count(*) AS n FROM l GROUP BY source),
p AS (SELECT l.*, s.grp, s.n, row_number() OVER (PARTITION BY s.grp ORDER BY doc_id NULLS FIRST, leaf, given) - 1 AS pos
      FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source),
t AS (
  SELECT grp AS tree, 0 AS lvl, pos, leaf AS h, n FROM p
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), max(n + 2) // 3 FROM t WHERE n > 1 GROUP BY tree, lvl, pos // 3),
sub AS (SELECT tree AS grp, h AS subroot FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, grp AS pos, subroot AS h, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), max(n + 2) // 3 FROM u WHERE n > 1 GROUP BY lvl, pos // 3),
runs AS (
  SELECT tree, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, lvl, pos // 3, list(h ORDER BY pos) FROM u WHERE n > 1 GROUP BY ALL),
c AS (
  SELECT rid, grp, n, (SELECT count(*) FROM sub) AS groups, grp AS tree, 0 AS lvl, pos, given AS folded, '' AS sib, n AS size FROM p
  UNION ALL
  SELECT c.rid, c.grp, c.n, c.groups, CASE WHEN c.size = 1 THEN -1 ELSE c.tree END, CASE WHEN c.size = 1 THEN 0 ELSE c.lvl + 1 END,
         CASE WHEN c.size = 1 THEN c.grp ELSE c.pos // 3 END,
         CASE WHEN c.size = 1 THEN c.folded ELSE sha256(array_to_string(r.hs[:c.pos % 3], '') || c.folded || array_to_string(r.hs[c.pos % 3 + 2:], '')) END,
         CASE WHEN c.size = 1 THEN c.sib ELSE c.sib || array_to_string(r.hs[:c.pos % 3], '') || array_to_string(r.hs[c.pos % 3 + 2:], '') END,
         CASE WHEN c.size = 1 THEN c.groups ELSE (c.size + 2) // 3 END
  FROM c LEFT JOIN runs r ON r.tree = c.tree AND r.lvl = c.lvl AND r.run = c.pos // 3
  WHERE NOT (c.size = 1 AND c.tree = -1))
SELECT p.doc_id, p.leaf, sub.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(c.sib) AS proof_sha256, c.folded AS folded_root,
       c.folded = (SELECT h FROM u WHERE n = 1) AS verified
FROM p JOIN sub USING (grp) JOIN c ON c.rid = p.rid AND c.tree = -1 AND c.size = 1
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a document with a smaller id holds too are removed."""
    return substring_dedup.digest(documents(spark, sf_dir))


ORACLES["op12_substring_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT rid, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
g AS (SELECT rid, doc_id, p AS i, lead(word, 12) OVER o AS last,
             concat_ws(' ', word, {", ".join(f"lead(word, {k}) OVER o" for k in range(1, 13))}) AS s
      FROM x WINDOW o AS (PARTITION BY rid ORDER BY p)),
v AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM g WHERE last IS NOT NULL) WHERE least < doc_id),
c AS (SELECT DISTINCT rid, i + k AS p FROM v, (SELECT unnest(range(13)) AS k)),
k AS (SELECT x.rid, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
      FROM x LEFT JOIN c ON c.rid = x.rid AND c.p = x.p WHERE c.p IS NULL GROUP BY x.rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every vector whose id is divisible by 100 and each of its five positives, the ten hardest negatives in range."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(hard_negatives.prepared(vectors), 5, 10, 30, 90, 100)


ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS a_row, a.id AS anchor_id, a.label = v.label AS alike, v.row, v.id,
         CAST(coalesce(list_sum(list_transform(list_zip(a.c, v.c), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.id % 100 = 0 AND a.row <> v.row),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a_row ORDER BY score DESC, id NULLS LAST, row) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a_row, p.row ORDER BY s.score DESC, s.id NULLS LAST, s.row) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a_row = s.a_row AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
