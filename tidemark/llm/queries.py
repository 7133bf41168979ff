"""The operators' registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    bpe, bpe_documents, divergence, embedding_dedup, fingerprints, licenses, line_dedup, ngram_join, packing, quality,
    secret_scan, sharding, toxicity, whitening,
)
from tidemark.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        capacity=4096, end_id=1)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), width=3, percent=90)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_secrets(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_documents.by_method(bpe_documents.encode_documents(
        table(spark, sf_dir, "documents"), ranks, then=bpe_documents.Digests(bpe.read_ranks(ranks))))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, least_chars=20, least_docs=3).insert(docs)
    return line_dedup.digest_kept(index.drop_lines(docs))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"), least_docs=10, top=10)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_toxicity, op3_best_fit_packing, op4_ngram_jaccard_join, op5_license_scan, op6_sharding,
    op7_secret_scan, op8_embedding_near_dedup, op9_byte_bpe, op10_document_fingerprints, op11_embedding_whitening,
    op12_line_dedup, op13_source_divergence)}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# DuckDB has neither crc32 nor match positions, and most other operators train, iterate or call a
# tokenizer: those are tested against a plain version instead.
ORACLE: dict[str, str] = {
    "op12_line_dedup": rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT rid, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LETTERS}) AS key
          FROM lines),
held AS (SELECT key, count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INTEGER) AS docs, max(doc_id) AS largest
         FROM keyed WHERE length(key) >= 20 GROUP BY key),
marked AS (SELECT k.*, h.docs >= 3 AND k.doc_id IS DISTINCT FROM h.largest AS gone
           FROM keyed k LEFT JOIN held h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NOT TRUE), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id""",
    "op13_source_divergence": rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                     coalesce(source, '') AS source FROM documents),
words AS (SELECT rid, lang, source, unnest(regexp_extract_all(
            translate(text, {_LETTERS}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM vocabulary GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
kept AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN vocabulary USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM kept GROUP BY ALL),
cells AS (SELECT g.lang, g.source, o.term, coalesce(k.n, 0) AS n,
            1 + 1000000000 * (coalesce(k.n, 0) + 2)::HUGEINT // (coalesce(t.total, 0) + 2 * s.v) AS p,
            1 + 1000000000 * (o.lang_n + 2)::HUGEINT // (s.lang_total + 2 * s.v) AS q
          FROM groups g JOIN vocabulary o USING (lang) JOIN sizes s USING (lang)
          LEFT JOIN kept k ON k.lang = g.lang AND k.source = g.source AND k.term = o.term
          LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM cells WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
               FROM found) WHERE part = 'pair' OR rank <= 10""",
}
