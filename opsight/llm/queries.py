"""Registered queries of the corpus operators: thin digests of each operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsight.llm import (fingerprints, html_crf, line_dedup, mixing, ngram_join, periodic_runs, quality_rules, secret_ledger,
                         sentencepiece_bpe, spelling_variants, substring_dedup, url_rules, warc)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, folder, "documents"))


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.url_verdicts(_table(spark, folder, "pages"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_table(spark, folder, "documents"))


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_bpe.token_report(_table(spark, folder, "documents"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_crf.extracted(_table(spark, folder, "pages"))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_report(_table(spark, folder, "documents"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return secret_ledger.secret_report(_table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_report(_table(spark, folder, "pages"))


def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup_report(_table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.spelling_variants(_table(spark, folder, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_url_rules": op2_url_rules,
        "op3_line_dedup": op3_line_dedup,
        "op4_mixing": op4_mixing,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_html_extraction": op6_html_extraction,
        "op7_fingerprints": op7_fingerprints,
        "op8_quality_rules": op8_quality_rules,
        "op9_secret_ledger": op9_secret_ledger,
        "op10_warc": op10_warc,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_spelling_variants": op13_spelling_variants,
    }


# Windows of 20 words are compared as text; a word goes if one of the windows over it starts earlier elsewhere.
_SUBSTRING_DEDUP = r"""WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), v AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j, len(words) AS n FROM w),
k AS (SELECT doc_id, j, n, word, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)) AS h FROM v),
e AS (SELECT doc_id, j, word, j <= n - 19 AND row_number() OVER (PARTITION BY h, j <= n - 19 ORDER BY doc_id, j) > 1 AS later FROM k),
m AS (SELECT doc_id, j, word, bool_or(later) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM e),
s AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN s USING (doc_id)"""

# A page's record follows from the pages of equal payload (equal SHA-1 and length).
_WARC = r"""WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS url FROM pages
), d AS (SELECT page_id, url, sha1(html) AS payload_digest, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes FROM p),
l AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to, url FROM l"""


def llm_oracles() -> dict[str, str]:
    """SQL of the operators whose whole result it can express; the others are tested against brute force."""
    return {"op10_warc": _WARC, "op11_substring_dedup": _SUBSTRING_DEDUP}
