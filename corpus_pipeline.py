"""Documents to token sequences: without toxic ones, near copies and benchmark passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywood.llm import decontaminate, near_copies, packing, toxicity
from tallywood.llm.frames import shipped, table
from tallywood.llm.queries import vocabulary
from tallywood.plans.scratch import scratch_path

# A document with this score or more is rejected.
TOXIC = 0.3


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, fitted on all labels, does not reject."""
    shipped(spark)
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rated = toxicity.score(docs, machine)
    return rated.where(rated["score"] < TOXIC).select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: three-word shingles, three differing bits or fewer."""
    shipped(spark)
    return near_copies.one_of_each(docs, words=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten successive words of a benchmark item occur."""
    shipped(spark)
    found = decontaminate.search(docs, table(spark, sf_dir, "benchmark"))
    return found.where("n_hit = 0").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the sequences of 4096 tokens."""
    shipped(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

# Trained models, SimHash groups and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each result but the last is written first."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
