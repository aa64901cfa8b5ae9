"""A training corpus from raw documents, in five stages over whole tables.

Each stage is a function of the session, the documents so far and the folder of the tables. What it returns is
written as Parquet and read again as the next stage's documents; all but the last keep the documents' columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartlens.llm import decontamination, jaccard, langid, mixing, shards
from cartlens.llm.frames import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or mostly in no language that the labelled ones teach, go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles, the one with the smallest id stays."""
    return jaccard.first_of_groups(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out until the sources have their target weights."""
    return mixing.repeat_documents(docs)


def materialise_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token sequences in training order, and a row for each slot."""
    return shards.materialise(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mix_sources", mix_sources),
    ("training_shards", materialise_tokens),
]

# A language model's decisions and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
