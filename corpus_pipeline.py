"""Corpus pipeline: documents -> token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; ``run`` writes every stage's result as Parquet in the shared
folder and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postscope.llm import byte_bpe, line_dedup, ngram_join, poisson_mix, quality_rules
from postscope.llm.common import Scratch, table
from postscope.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar lines one occurrence stays; documents that
    keep no line go."""
    return line_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document by its source's repetition rate, shuffled."""
    return poisson_mix.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document (copy)."""
    return byte_bpe.encode(docs, *vocabulary(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("poisson_mix", mixed),
    ("byte_bpe", tokens),
]

#: The stages (learned cutoffs, MinHash, BPE) can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
        scratch.keep(docs)
    return docs
