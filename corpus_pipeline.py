"""Corpus pipeline: toxicity, near-duplicates, decontamination, personal data, mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows that go on.  Every result is written as Parquet and read again
as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last adds the repetition columns of the mixture.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spreadlab.llm import decontaminate, mixing, neardup, privacy, toxicity
from spreadlab.llm.common import table
from spreadlab.session import configure, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain field doesn't call toxic."""
    configure(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    configure(spark)
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    configure(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and the terms that disclose it replaced by their kind."""
    configure(spark)
    return privacy.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled."""
    configure(spark)
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", sanitise),
    ("mixing", mix),
]

#: A trained field and sketches are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
