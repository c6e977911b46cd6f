"""The registered queries of this package, each over whole tables, and SQL
for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrecon.llm import bpe, packing, pieces, quality
from acctrecon.llm.common import table
from acctrecon.llm.embeddings import embedding_near_dedup
from acctrecon.llm.exact_dedup import exact_dedup
from acctrecon.llm.lexical import ranked_search
from acctrecon.llm.line_dedup import line_dedup
from acctrecon.llm.lm_score import cross_entropy_difference
from acctrecon.llm.quotes import link_quotes
from acctrecon.llm.simhash import simhash_near_dedup
from acctrecon.llm.warc import archive_round_trip
from acctrecon.llm.whitening import whiten

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), RANKS)
    return bpe.decode_documents(encoded, RANKS).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, added=True).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "bucket")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_documents(table(spark, sf_dir, "documents"), PIECES)
    return pieces.decode_documents(encoded, PIECES).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_line_dedup, op3_warc, op4_quotes, op5_bpe, op6_lm_score,
                            op7_exact_dedup, op8_embedding_dedup, op9_simhash, op10_packing, op11_whitening,
                            op12_lexical, op13_pieces)}

_SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

ORACLE_SQL = {
    "op2_line_dedup": f"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut),
shared AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, s.owner IS NOT NULL AND s.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op3_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS keep FROM p)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND keep <> page_id THEN keep END AS refers_to
FROM g""",
    "op7_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM t WINDOW same AS (PARTITION BY body)""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e)
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, r.component_id, v.vec_id = r.component_id AS kept
FROM v JOIN root r ON r.a = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id""",
    "op12_lexical": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term),
size AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d),
total AS (SELECT count(*) FILTER (WHERE n > 0) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
posting AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM posting CROSS JOIN total GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms)))))::BIGINT
    AS score
  FROM wanted JOIN posting USING (term) JOIN weight USING (term) JOIN size USING (r) CROSS JOIN total
  GROUP BY item_id, doc_id, r),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
