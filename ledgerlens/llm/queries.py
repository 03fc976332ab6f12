"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    exact_dedup,
    hard_negatives,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.fit_and_identify(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "labels"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("byte_bpe_50k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(spark, sf_dir)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_language_id, op3_quality, op4_minhash_near_dedup, op5_exact_dedup,
        op6_toxicity, op7_decontamination, op8_token_counts, op9_best_fit_packing,
        op10_lm_scoring, op11_hard_negatives, op12_warc, op13_prefix_trie)}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id,
               count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY text) AS kept,
               sha256(text) AS text_sha256
        FROM d
    """,
    "op11_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x)
                                          FOR x IN embedding]), true)
        ), s AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, e.vec_id, e.label,
                   list_dot_product(a.v, e.v)::BIGINT AS score
            FROM e AS a JOIN e ON a.vec_id <> e.vec_id
            WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s
            WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), n AS (
            SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score,
                   score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id
                                      ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND label <> anchor_label
             AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10
    """,
    "op12_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept,
                   regexp_replace(url, ' ', '%20', 'g') AS url
            FROM pages
        )
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
               list_aggregate([substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(sha1(payload), 5 * (i // 4)::INTEGER + 1, 5))::INTEGER
                         >> (15 - 5 * (i % 4))::INTEGER) & 31), 1) FOR i IN range(32)],
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> kept THEN kept END AS refers_to, url
        FROM p
    """,
}
