"""Registered queries of the training-data operators, with SQL where it fits."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from indicata.llm import (ann_graph, chaining, chunk_recipes, filter_audit, importance, jaccard_join, mixing,
                          packing, pii, suffix_dedup, url_filters, warc, whitening)
from indicata.llm.common import table


def op1_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.detect(table(spark, sf_dir, "documents")))


def op4_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.dedup(table(spark, sf_dir, "documents"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scores = importance.weigh(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", F.round("log_weight", 6).alias("log_weight"), "kept")


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.clean(table(spark, sf_dir, "documents"), keep=False)


def op8_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_graph.nearest(table(spark, sf_dir, "embeddings"))


def op9_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*(url_filters.site_rule(*r) for r in url_filters.SITE_RULES),
             *(url_filters.word_rule(w) for w in url_filters.BLOCK_WORDS)]
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_chained_passages, op2_source_mix, op3_pii_spans, op4_chunk_recipes,
                                  op5_importance_resampling, op6_pack_sequences,
                                  op7_suffix_dedup, op8_graph_neighbours, op9_jaccard_classes,
                                  op10_url_filters, op11_filter_audit, op12_warc_bundles,
                                  op13_embedding_whitening)}
QUERIES["pipeline"] = corpus_pipeline.run

_OP4 = r"""
WITH norm AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, text_sha256
FROM norm WINDOW same AS (PARTITION BY text_sha256)
"""

_WORDS = "|".join(url_filters.BLOCK_WORDS)
_OP10 = rf"""
WITH cut AS (
  SELECT page_id, row_number() OVER () AS r,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(rules.verdict, length(h || p)) AS verdict
  FROM cut JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict,
         CASE WHEN regexp_matches(lower(host || path), '(^|[^a-z0-9])({_WORDS})([^a-z0-9]|$)')
              THEN 'block' ELSE 'allow' END) AS verdict
FROM cut LEFT JOIN fits USING (r)
"""

_OP11 = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(w) < 200, 100 * list_unique(w) < 50 * len(w),
          100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)] AS f
  FROM words LEFT JOIN told ON words.doc_id = told.doc_id),
cells AS (SELECT part, f, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
letters(c, k) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS ks
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT filter_order, ks, unnest([1, 2, 3, 4, 5])::INTEGER AS step FROM orders),
counted AS (
  SELECT part, filter_order, step, ks[step] AS k,
         sum(CASE WHEN NOT before AND NOT f[ks[step]] THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT before AND f[ks[step]] THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN before AND f[ks[step]] THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f[ks[step]] AND len(list_filter(f, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT before AND f[ks[step]] AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT before AND f[ks[step]] AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM (SELECT *, len(list_filter(ks[1:step - 1], lambda j: f[j])) > 0 AS before FROM cells, steps)
  GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM counted
"""

_OP12 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
ranked AS (
  SELECT *, strlen(h) >= 100 AND row_number() OVER same > 1 AS again, first_value(page_id) OVER same AS head
  FROM p WINDOW same AS (PARTITION BY h ORDER BY page_id NULLS LAST))
SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN head END AS refers_to
FROM ranked
"""

ORACLE = {"op4_chunk_recipes": _OP4, "op10_url_filters": _OP10, "op11_filter_audit": _OP11,
          "op12_warc_bundles": _OP12}
