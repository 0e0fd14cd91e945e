"""Registered queries of this package, over whole tables, and their SQL twins.

Each query gets its rows through its operator and derives the columns that it returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tenura.llm.alignment import aligned
from tenura.llm.common import table
from tenura.llm.exact_dedup import exact_groups
from tenura.llm.langid import identified
from tenura.llm.lm import cross_entropy_difference
from tenura.llm.minhash import near_groups
from tenura.llm.mixing import shares
from tenura.llm.packing import packed_pieces
from tenura.llm.quality import quality
from tenura.llm.simhash import near_components
from tenura.llm.toxicity import scored
from tenura.llm.urls import judge_urls
from tenura.llm.warc import round_trip
from tenura.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans come along as one string, such as ``en:0+12 fr:12+7`` (first word + words)."""
    found = identified(table(spark, sf_dir, "documents"))
    spans = F.expr("array_join(transform(spans, s -> concat(s.lang, ':', s.start, '+', s.words)), ' ')")
    return found.select("doc_id", "held_out", F.col("lang").alias("lang_pred"), "score", spans.alias("spans"))


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))


def op13_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_toxicity,
        op3_exact_dedup,
        op4_quality_rules,
        op5_pack_sequences,
        op6_simhash_components,
        op7_cross_entropy,
        op8_language_spans,
        op9_warc_round_trip,
        op10_url_filter,
        op11_whiten_embeddings,
        op12_align_tokenizers,
        op13_minhash_groups,
    )
} | {"pipeline": corpus_pipeline.run}

LLM_ORACLES: dict[str, str] = {
    "op3_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
""",
    "op9_warc_round_trip": r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op10_url_filter": r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fitting AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts, rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fitting USING (page_id)
""",
}
