"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motifspark.llm import (ball_tree, bpe_automaton, html_consensus, line_chunks, mixing, projection_passes, quality_rules, secrets_scan, simhash, suffix_dedup,
                            token_rollup, url_filter, whitening)
from motifspark.llm.common import n_words, shared_folder, table


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; only the queries name one, the operators take any path."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select("doc_id", *[f"quality_rules.{c}" for c in (*quality_rules.COUNTS[:5], "base_failed", "rule", "kept")])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return decisions.select("doc_id", "size", "source_size", "target", "taken")


def op5_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_passes.near_groups(table(spark, sf_dir, "embeddings"), least=0.95)


def op6_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, distance=2)


#: Pieces: runs of letters, single digits, runs of other marks. Whole words: words that hold a letter or digit.
PIECES = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]+"
WHOLE_WORDS = r"[^\x20\x09-\x0D]*[\p{L}\p{N}][^\x20\x09-\x0D]*"


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all counts under two tokenizer versions, revise one, delete the counts of repeated texts, replay batches."""
    docs = table(spark, sf_dir, "documents")
    matches = lambda p: F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0))
    rollup = token_rollup.TokenRollup(spark, shared_folder(spark, "token_rollup"))
    rollup.apply(1, token_rollup.counts(docs, "insert", "words-1", n_words(F.col("text"))))
    rollup.apply(2, token_rollup.counts(docs, "insert", "pieces-1", matches(PIECES)))
    revised = token_rollup.counts(docs, "revise", "words-1", matches(WHOLE_WORDS))
    rollup.apply(3, revised)
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    first = keyed.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = keyed.join(first, "h").where("doc_id > first").select(
        F.lit("delete").alias("op"), "doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"),
        F.explode(F.array(F.lit("words-1"), F.lit("pieces-1"))).alias("version"), F.lit(None).cast("long").alias("n_tokens"))
    rollup.apply(4, copies)
    for batch in (3, 4):  # sent again: no effect
        if rollup.apply(batch, revised):
            raise RuntimeError("a committed batch was applied twice")
    return rollup.totals()


ROLLUP_SQL = rf"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS nth FROM documents),
k AS (SELECT source, lang, text FROM d WHERE text IS NULL OR nth = 1)
SELECT source, lang, 'words-1' AS version, count(*)::BIGINT AS n_docs, sum(len(regexp_extract_all(coalesce(text, ''), '{WHOLE_WORDS}')))::BIGINT AS n_tokens FROM k GROUP BY ALL
UNION ALL
SELECT source, lang, 'pieces-1', count(*)::BIGINT, sum(len(regexp_extract_all(coalesce(text, ''), '{PIECES}')))::BIGINT FROM k GROUP BY ALL
"""


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_chunks.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"line_dedup.{c}" for c in ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")],
                        F.sha2(F.coalesce("line_dedup.kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract(table(spark, sf_dir, "pages"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_documents(table(spark, sf_dir, "documents"), tokenizer_file(),
                                          keep=("n_tokens", "ids_sha256", "decoded_sha256"))


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


#: (host, path, verdict) of the contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_linked_secrets": op3_linked_secrets,
    "op4_pareto_mix": op4_pareto_mix,
    "op5_projection_passes": op5_projection_passes,
    "op6_simhash_pigeonhole": op6_simhash_pigeonhole,
    "op7_token_rollup": op7_token_rollup,
    "op8_line_chunks": op8_line_chunks,
    "op9_html_consensus": op9_html_consensus,
    "op10_bpe_automaton": op10_bpe_automaton,
    "op11_ball_tree_search": op11_ball_tree_search,
    "op12_whitening": op12_whitening,
    "op13_url_filter": op13_url_filter,
}
ORACLE: dict[str, str] = {
    "op3_linked_secrets": secrets_scan.oracle_sql(),
    "op4_pareto_mix": mixing.ORACLE_SQL,
    "op7_token_rollup": ROLLUP_SQL,
    "op8_line_chunks": line_chunks.ORACLE_SQL,
    "op11_ball_tree_search": ball_tree.oracle_sql(),
}
