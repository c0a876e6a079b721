"""Corpus pipeline: the stages from raw documents to token files.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and, but for the last, returns the
columns of docs as they came, extra ones included. Defined cases, for every stage: a null text is a text
without words; a null lang, source or doc_id is a value like any other; rows that repeat an id are rows of
their own; an empty table gives an empty result of the same columns.

A stage's result must be written before the next stage is called, as run() does: a stage begins by
deleting the intermediate files of the one before it in this application.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontam, mixing, near_dedup, quality, token_files
from tallyhouse.llm.registry import tokenizer_path
from tallyhouse.session import clear_work, work_scope
from tallyhouse.storage import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SCOPE = "pipeline-stage"


def _tidy(stage: Stage) -> Stage:
    """The stage in a work folder of its own, which the stage before has left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear_work(spark, SCOPE)
        with work_scope(SCOPE):
            return stage(spark, docs, sf_dir)

    return run_stage


@_tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Texts under 50 words go, null and empty ones with them; a language with too few documents for a
    reference is judged by the base rules only. Equal rows share their fate.
    """
    return quality.keep_good(docs)


@_tidy
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id.

    Rows without words are in no group and stay, repeated or not. Of equal rows one stays. A group in
    which no row has an id keeps one row; a null id never is the smallest.
    """
    return near_dedup.deduplicate(docs)


@_tidy
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages beyond the contamination rule.

    Documents without words stay; items without words match nothing; without items all documents stay.
    """
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and documents of small sources again, to the temperature weights.

    Null and empty sources are one source. Documents without words are used once. Equal rows are
    repeated together.
    """
    return mixing.realised(docs)


@_tidy
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix; returns what they hold of each document.

    One row a document taken: a null or empty text has the end id only; null ids come first; a document
    that was taken twice has two rows.
    """
    return token_files.token_ids(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: Several stages (tokenizer, coder, mixing) have no SQL form; tests hold the run against plain code.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
