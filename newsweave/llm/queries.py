"""The operators' registered queries, each on its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsweave.llm import (
    decontamination,
    embedding_dedup,
    fim,
    language_id,
    line_dedup,
    lm_scoring,
    minhash_dedup,
    mixing,
    packing,
    resampling,
    secret_scan,
    suffix_dedup,
    token_counts,
)
from newsweave.session import tune

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(tune(spark), sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup, op2_secret_scan, op3_suffix_dedup, op4_embedding_dedup, op5_token_counts, op6_packing, op7_line_dedup, op8_language_id,
        op9_decontamination, op10_lm_scoring, op11_fim, op12_importance_resampling, op13_mixing, pipeline,
    )
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op11_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
    CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d
),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
),
parts AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
    "op12_importance_resampling": f"""
WITH steps AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)
),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
runs AS (
  SELECT true AS own, doc_id, unnest(w) AS g FROM d
  UNION ALL SELECT true, doc_id, w[i] || ' ' || w[i + 1] FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)
  UNION ALL SELECT false, NULL, unnest(w) FROM b
  UNION ALL SELECT false, NULL, w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)
),
counted AS (SELECT own, doc_id, g, count(*) AS n FROM runs GROUP BY ALL),
grams AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM counted)),
bytes AS (SELECT g, list_transform(range(1, len(x) // 2 + 1), lambda i: CAST('0x' || substr(x, CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT)) AS x FROM grams),
hashed AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295, x), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc
),
placed AS (SELECT own, doc_id, bucket, n FROM counted JOIN hashed USING (g)),
per AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t FROM placed GROUP BY bucket),
total AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM per),
gain AS (SELECT bucket, floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS v FROM per, total),
mean AS (SELECT doc_id, sum(n) AS n, floor(sum(n * v) / sum(n)) AS weight FROM placed JOIN gain USING (bucket) WHERE own GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(w) >= 20 AS able, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN mean ON mean.doc_id = d.doc_id
),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE able),
size AS (SELECT 25 * count(*) // 100 AS k FROM ranked)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank
FROM scored s CROSS JOIN size LEFT JOIN ranked r ON r.doc_id = s.doc_id""",
    "op9_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM cut),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d JOIN (SELECT DISTINCT k FROM windows) ON len(w) >= k),
hits AS (
  SELECT doc_id, s, p.k AS k, item FROM (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g FROM places) p
  JOIN windows v ON p.k = v.k AND p.g = v.g
),
hit_words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS word FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id""",
}
