"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, jaccard, leaks, lexical, licenses, negatives, pii, quality, sentences, toxicity, urls, voronoi, wordpiece


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.knn_join(table(spark, sf_dir, "embeddings"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.removed_stretches(table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_spaced_seeds": op2_spaced_seeds,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_bpe": op5_bpe,
    "op6_jaccard": op6_jaccard,
    "op7_token_counts": op7_token_counts,
    "op8_voronoi": op8_voronoi,
    "op9_licenses": op9_licenses,
    "op10_sentence_spans": op10_sentence_spans,
    "op11_lexical": op11_lexical,
    "op12_negatives": op12_negatives,
    "op13_urls": op13_urls,
}
ORACLES = {
    "op8_voronoi": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op11_lexical": r"""
        WITH words AS (
            SELECT row, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
        ), counted AS (
            SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL
        ), sized AS (
            SELECT row, sum(tf) AS n FROM counted GROUP BY row
        ), whole AS (
            SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
        ), weighed AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM counted, whole GROUP BY term, n_docs
        ), items AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL
        ), scored AS (
            SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (CAST(90 * n * n_docs AS BIGINT) // n_terms))))) AS BIGINT) AS score
            FROM items JOIN weighed USING (term) JOIN counted USING (term) JOIN sized USING (row), whole
            GROUP BY item_id, doc_id, row
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored
            WHERE score > 0 AND doc_id IS NOT NULL
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v d ON d.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same
            ) WHERE place <= 5
        ), ranked AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
            FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM ranked WHERE rank <= 3
    """,
}
