"""The registered queries opN_<name>: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, cotraining, embedding_dedup, license_scan, quality_rules, simhash, suffix_dedup, token_store, trie_bpe, whole_token_counts
from tessera.llm.common import documents, id_text, prepare


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's counts and verdicts of every document; a null text has no words and fails."""
    judged = quality_rules.judge(id_text(documents(spark, sf_dir)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
keyed AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS k FROM win),
twice AS (SELECT rid, i FROM keyed QUALIFY count(*) OVER (PARTITION BY rid, k) >= 2),
cover AS (SELECT rid, CAST(sum(least(8, nxt)) AS BIGINT) AS n FROM (
    SELECT rid, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8) AS nxt FROM twice) GROUP BY rid),
s AS (SELECT w.rid, doc_id, text, lines, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(cover.n, 0) AS n_repeat_words,
        length(regexp_replace(text, '\P{Lu}', '', 'g')) AS upper_chars,
        length(regexp_replace(text, '\P{L}', '', 'g')) AS letters,
        length(regexp_replace(text, '[^{}]', '', 'g')) AS braces
      FROM w LEFT JOIN cover USING (rid)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(n_words, 1) AS m FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * m OR word_chars > 20 * m OR word_chars < 2 * m
    OR (len(lines) >= 4 AND 2 * n_dup_lines > len(lines)) OR 2 * upper_chars > letters OR 2 * letters < word_chars
    OR (len(lines) >= 4 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) > 5 * len(lines))
    OR (len(lines) >= 4 AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-•*]'))) > 9 * len(lines))
    OR braces > m) AS kept
FROM j
"""


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept of every document; null ids and texts as in ``cotraining``."""
    return cotraining.classify(documents(prepare(spark), sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the shards; a null text is its end id alone."""
    return token_store.stored(id_text(documents(prepare(spark), sf_dir)), end_id=2)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; a null text counts nothing."""
    return whole_token_counts.count_tokens(id_text(documents(prepare(spark), sf_dir)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector; vectors without a direction link with nothing."""
    return embedding_dedup.near_duplicates(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document; texts without words have fingerprint zero."""
    found = simhash.near_duplicates(id_text(documents(prepare(spark), sf_dir)))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp.f0"), 16, "0")).alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and what is left of the text of every document; null: empty."""
    return suffix_dedup.report(id_text(documents(prepare(spark), sf_dir)))


def op8_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document; a null text has no ids."""
    return trie_bpe.round_trip(id_text(documents(prepare(spark), sf_dir)))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's counts and labels of every document; a null text has no words and no labels."""
    return license_scan.scan_documents(id_text(documents(prepare(spark), sf_dir)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece; a null text is its end id alone."""
    return best_fit_packing.pack_documents(id_text(documents(prepare(spark), sf_dir)), capacity=2048, end_id=0)


QUERIES = {
    "op1_cotraining": op1_cotraining,
    "op2_token_store": op2_token_store,
    "op3_token_counts": op3_token_counts,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_simhash": op5_simhash,
    "op9_license_scan": op9_license_scan,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_trie_bpe": op8_trie_bpe,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
}
SQL = {"op6_quality_rules": OP6_SQL}
