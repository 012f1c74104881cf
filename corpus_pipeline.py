"""A corpus pipeline of the operators in ``starloom.llm``: each stage reads what its predecessor kept.

1. ``language``: documents without a letter, or in none of the languages that the corpus itself is labelled with, go.
2. ``toxicity``: documents that the learned scorer predicts as toxic go.
3. ``near_duplicates``: of each group of near copies the document with the smallest id stays.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``mix``: what is left becomes a training stream, one row for each time a document is used, in order of training position.

All stages but the last return the columns of their input. A stage given an empty table returns an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontamination, dedup, language, mixing, toxicity
from starloom.llm.common import ensure_checkpoint_dir, load, workers_import


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return language.in_known_language(docs, language.learn_prototypes(docs.where(~language.held_out())))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels")
    model = toxicity.learn_toxicity(docs.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    return toxicity.without_toxic(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return dedup.without_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_rows(docs)


STAGES = [
    ("language", identify_language),
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mix", mix),
]

#: Learned models and hash bands decide the first four stages: no SQL. Tests check each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again by the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{folder}/{k + 1}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
