"""A corpus pipeline of five operators: reject, clean, deduplicate, mix, tokenize.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the shared folder as
Parquet and reads it back as the next stage's documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motifspark.llm import bpe_automaton, line_chunks, mixing, quality_rules, simhash
from motifspark.llm.common import free_name, materialise, small_batches, table
from motifspark.llm.queries import tokenizer_file


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep, unchanged."""
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "quality_rules")
    return quality_rules.judge(docs, rules, name=name).where(F.col(f"`{name}`.kept")).select(*[f"`{c}`" for c in docs.columns])


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without chunks of lines that stand earlier; n_chars follows the new text."""
    name = free_name(docs, "line_dedup")
    found, kept = line_chunks.dedup_lines(docs, name=name), F.col(f"`{name}`.kept")
    changed = {"text": kept} | ({"n_chars": F.length(kept).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, distance=2)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)[1]


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and the digests of ids and decoded text."""
    small_batches(spark)
    return bpe_automaton.encode_documents(docs, tokenizer_file(), keep=("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [("quality rules", stage_quality), ("line dedup", stage_lines), ("simhash near-dedup", stage_near),
          ("mix to target weights", stage_mix), ("bpe encode and decode", stage_tokens)]

#: A learned list, majority fingerprints and BPE have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline {name}")
    return docs
