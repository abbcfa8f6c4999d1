"""The corpus pipeline: documents through toxicity, language, near copies, benchmark text, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in
the cluster's shared folder and the next stage reads that. All stages but the last return the
columns of ``documents``; the last one adds the mix's counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizlake.llm.decontam import decontaminate
from quizlake.llm.langid import accepted
from quizlake.llm.mixing import mixed
from quizlake.llm.sketch_join import one_of_each
from quizlake.llm.store import saved, ship, table
from quizlake.llm.toxicity import clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the recurrent network predicts toxic go."""
    return clean(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that no language's model fits, go."""
    ship(spark)
    return accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents the one with the smallest doc_id stays."""
    ship(spark)
    return one_of_each(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mainly benchmark text go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, and how many of their words (repeats counted)."""
    ship(spark)
    return mixed(docs)


STAGES = [("toxicity", toxicity), ("language", language), ("near_copies", near_copies),
          ("benchmark_text", benchmark_text), ("mix", mix)]

#: Trained models and sketches are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
