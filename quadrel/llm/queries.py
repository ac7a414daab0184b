"""The queries of the corpus operators over the driver's tables, with production parameters."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.llm import (
    exact_dedup, exact_packing, fill_middle, fingerprints, packing, periodic_runs, pii, simhash, suffix_dedup, token_counts, toxicity, viterbi, warc,
)
from quadrel.llm.fingerprints_sql import fingerprint_table_sql
from quadrel.llm.periodic_runs_sql import digests_sql as runs_sql
from quadrel.llm.simhash_sql import near_classes_sql


def _tokenizer(name: str) -> str:
    """Path of a public tokenizer's file on the executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


_drawn_keys: dict[str, str] = {}


def surrogate_key(spark: SparkSession, published: str | None = None) -> str:
    """The key of surrogates, from ``spark.quadrel.surrogateKey``; where none is set, a published one for synthetic tables, or one drawn for this application.

    Surrogates under a drawn key are the same throughout the application, and no one can tell
    from them what they stand for; to have the same ones again another day, set the key.
    """
    named = spark.conf.get("spark.quadrel.surrogateKey", published)
    return named or _drawn_keys.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_classes(_table(spark, sf_dir, "documents")).select(
        F.col("ident").alias("doc_id"), F.col("keep_ident").alias("keep_id"), "group_size", "kept", "text_sha256"
    )


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY plain) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(plain) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY plain ORDER BY length(text) DESC, doc_id)
"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = _table(spark, sf_dir, "documents")
    return token_counts.section_counts(documents, _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).select(
        "doc_id", "section", "start", "end", F.col("tokens").cast("long").alias("tokens"), "doc_tokens"
    )


def op3_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(_table(spark, sf_dir, "documents"))


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


#: Windows are cut from stretches of 512 starts, as DuckDB walks to a place in a long text.
OP5_SQL = """
WITH whole AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_no, octet_length(encode(coalesce(text, ''))) AS n_bytes,
         hex(encode(coalesce(text, ''))) AS digits
  FROM documents),
stretches AS (
  SELECT row_no, n_bytes, base, substr(digits, 2 * base + 1, 2 * (512 + 199)) AS part
  FROM (SELECT row_no, n_bytes, digits, unnest(range(0, n_bytes - 199, 512)) AS base FROM whole WHERE n_bytes >= 200)),
starts AS (
  SELECT row_no, base + step AS first_byte, md5(substr(part, 2 * step + 1, 400)) AS gram
  FROM (SELECT row_no, base, part, unnest(range(least(512, n_bytes - 199 - base))) AS step FROM stretches)),
often AS (SELECT gram FROM starts GROUP BY gram HAVING count(*) > 1),
covered AS (
  SELECT row_no, first_byte, coalesce(first_byte - lag(first_byte) OVER (PARTITION BY row_no ORDER BY first_byte) > 200, true) AS opens
  FROM starts SEMI JOIN often USING (gram)),
numbered AS (SELECT row_no, first_byte, sum(CAST(opens AS INT)) OVER (PARTITION BY row_no ORDER BY first_byte) AS span FROM covered),
spans AS (SELECT row_no, min(first_byte) AS opened, max(first_byte) + 200 AS closed FROM numbered GROUP BY row_no, span),
gaps AS (
  SELECT row_no, coalesce(lag(closed) OVER (PARTITION BY row_no ORDER BY opened), 0) AS kept_from, opened AS kept_to FROM spans
  UNION ALL
  SELECT w.row_no, coalesce(max(closed), 0), any_value(n_bytes) FROM whole w LEFT JOIN spans s ON s.row_no = w.row_no GROUP BY w.row_no),
kept AS (
  SELECT w.row_no, string_agg(substr(digits, 2 * kept_from + 1, 2 * (kept_to - kept_from)), '' ORDER BY kept_from, kept_to) AS digits,
         sum(kept_to - kept_from) AS n_kept, count(*) - 1 AS n_spans
  FROM whole w JOIN gaps g ON g.row_no = w.row_no GROUP BY w.row_no)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(n_bytes - n_kept AS BIGINT) AS n_removed, n_spans, sha256(unhex(k.digits)) AS kept_sha256
FROM whole w JOIN kept k ON k.row_no = w.row_no
"""


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(_table(spark, sf_dir, "documents"), words=3).select(
        F.col("ident").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op7_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.digests(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(_table(spark, sf_dir, "documents"), surrogate_key(spark, "for synthetic tables only"), report=True)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    machine = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    return toxicity.score(documents, machine).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(_table(spark, sf_dir, "documents"))


def op13_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_closed_syncmers": op3_closed_syncmers,
    "op4_warc_normaliser": op4_warc_normaliser,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_simhash_golay": op6_simhash_golay,
    "op7_sentencepiece_viterbi": op7_sentencepiece_viterbi,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_fill_middle": op11_fill_middle,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_exact_packing": op13_exact_packing,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op3_closed_syncmers": fingerprint_table_sql(),
    "op4_warc_normaliser": OP4_SQL,
    "op5_suffix_dedup": OP5_SQL,
    "op6_simhash_golay": near_classes_sql(),
    "op11_fill_middle": fill_middle.digests_sql(),
    "op12_periodic_runs": runs_sql(),
}
