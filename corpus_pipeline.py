"""From raw documents to token IDs: quality, exact and near duplicates, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it and the next stage
reads it again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import bpe_automaton, exact_dedup, jaccard_join, mixing, quality
from tastegraph.llm.common import table
from tastegraph.llm.queries import MIX_BUDGET, MIX_POWERS, mix_margins, tokenizer_definition
from tastegraph.session import written

# Entries of the encoder's tables: small, as its workers are those of the stages before.
KEPT_PIECES = 60_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality posterior is below one half."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest ID."""
    return exact_dedup.deduplicate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle similarity keep the one with the smallest ID."""
    return jaccard_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample MIX_BUDGET of the tokens toward the target shares of sources, languages and topics."""
    return mixing.mix(docs, mix_margins(), MIX_POWERS, budget=MIX_BUDGET)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document left."""
    coded = bpe_automaton.encode(docs, tokenizer_definition(), kept=KEPT_PIECES)
    return coded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("BPE encoding", tokens_stage),
]

# The classifier and the tokenizer have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
